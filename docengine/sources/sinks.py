"""Writers: tables, CSV, numbered texts, sheets per country, HTML pages, workbooks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T


def table(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def csv(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """All fields as safe text with a header; nothing is overwritten unless asked."""
    safe = df.select(*[F.coalesce(T.cell(F.col(c).cast("string")), F.lit("")).alias(c) for c in df.columns])
    safe.write.mode("overwrite" if overwrite else "errorifexists").options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``doc_id``, ``text``: the lines of each document with their numbers from 1."""
    g = lines.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    return g.select("doc_id", F.array_join(F.transform("l", lambda x: F.format_string("%6d  %s", x["line_no"] + 1, x["line"])), "\n").alias("text"))


def by_country(df: DataFrame, path: str, country: str = "country", overwrite: bool = False) -> None:
    """One folder a country; a large country is written by several tasks."""
    df.write.mode("overwrite" if overwrite else "errorifexists").partitionBy(country).parquet(path)


def json_payload(df: DataFrame, order: list[str], most_rows: int = 100_000) -> DataFrame:
    """One row: the records of a small table as a JSON array, in order; a table of more than ``most_rows`` raises an error."""
    if df.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"more than {most_rows} rows: write them as a table")
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"_{i}") for i, o in enumerate(order)], F.to_json(F.struct(*df.columns)).alias("j"))))
    return df.agg(F.concat(F.lit("["), F.array_join(F.transform(rows, lambda x: x["j"]), ","), F.lit("]")).alias("payload"))


def html_page(template: str, mark: str, payload: str) -> str:
    """A page with its data; the data cannot close the script it stands in."""
    return template.replace(mark, payload.replace("</", "<\\/"))


def _xlsx(sheets: list[tuple[str, list[str], Iterable[list[str | None]]]]) -> bytes:
    """An XLSX file of sheets (name, header, rows of text)."""
    buffer = io.BytesIO()
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    base = "http://schemas.openxmlformats.org"
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        count = range(1, len(sheets) + 1)
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in count)
        z.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="{base}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{types}</Types>')
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="{base}/package/2006/relationships"><Relationship Id="rId1" Type="{base}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(name)[:31]}" sheetId="{i}" r:id="rId{i}"/>' for i, (name, _, _) in zip(count, sheets))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{base}/spreadsheetml/2006/main" xmlns:r="{base}/officeDocument/2006/relationships"><sheets>{listed}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{i}" Type="{base}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in count)
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="{base}/package/2006/relationships">{rels}</Relationships>')
        line = lambda cells: "<row>" + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{escape(c or "")}</t></is></c>' for c in cells) + "</row>"
        for i, (_, header, rows) in zip(count, sheets):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<?xml version="1.0"?><worksheet xmlns="{base}/spreadsheetml/2006/main"><sheetData>{line(header)}{"".join(line(r) for r in rows)}</sheetData></worksheet>')
    return buffer.getvalue()


def workbook(sheets: dict[str, DataFrame], most_rows: int = 1_000_000) -> bytes:
    """An XLSX file with one sheet a table, for results of a size people read; larger ones raise an error."""
    parts = []
    for name, df in sheets.items():
        if df.limit(most_rows + 1).count() > most_rows:
            raise ValueError(f"{name} has more than {most_rows} rows: write it as a table")
        safe = df.select(*[T.cell(F.col(c).cast("string")).alias(c) for c in df.columns])
        parts.append((name, df.columns, (list(r) for r in safe.toLocalIterator())))
    return _xlsx(parts)


def country_workbooks(df: DataFrame, country: str = "country", order: list[str] | None = None, most_rows: int = 100_000) -> DataFrame:
    """``country``, ``n_rows``, ``content``: an XLSX file a country with its rows as a sheet, made where the rows are.

    Rows without a country go into one named blank. A country with more than ``most_rows`` raises an error: write it by ``by_country``.
    """
    safe = df.select(F.coalesce(F.col(country), F.lit("")).alias("_k"), *[T.cell(F.col(c).cast("string")).alias(c) for c in df.columns])
    large = safe.groupBy("_k").agg(F.count("*").alias("n")).where(F.col("n") > most_rows).select("_k").take(1)
    if large:
        raise ValueError(f"{large[0]['_k']} has more than {most_rows} rows: write them by country")
    columns, first = df.columns, order or df.columns

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(first)[columns].astype(object).where(pdf[columns].notna(), None).values.tolist()
        return pd.DataFrame([(pdf["_k"].iloc[0], len(rows), _xlsx([(pdf["_k"].iloc[0] or "no country", columns, rows)]))], columns=["country", "n_rows", "content"])

    return safe.groupBy("_k").applyInPandas(make, "country string, n_rows bigint, content binary")


def put(spark: SparkSession, path: str, content: bytes, overwrite: bool = False) -> None:
    """Writes one small file, such as a page or a workbook, to any folder Spark can write to; nothing is overwritten unless asked."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, overwrite)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
