"""Readers: reports, registers, review tables, numbered texts, JSON maps."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Destinations of an RTF file that hold no text, and its characters by control word.
_SKIPPED = {"fonttbl", "colortbl", "stylesheet", "info", "pict", "object", "header", "footer", "fldinst", "generator", "listtable", "listoverridetable", "themedata", "datastore", "xmlnstbl", "rsidtbl"}
_MARKS = {"par": "\n", "line": "\n", "row": "\n", "sect": "\n", "page": "\f", "tab": "\t", "cell": "\t", "emdash": "—", "endash": "–", "lquote": "‘", "rquote": "’", "ldblquote": "“", "rdblquote": "”", "bullet": "•"}
_TOKEN = re.compile(r"\\([a-z]{1,32})(-?\d{1,10})? ?|\\'([0-9a-fA-F]{2})|\\([^a-z])|([{}])|[\r\n]+|([^\\{}\r\n]+)", re.I)


def rtf_text(raw: str) -> str:
    """The text of an RTF document; destinations without text and pictures are left out."""
    out: list[str] = []
    stack: list[tuple[bool, int]] = []
    hidden, skip_chars, uc = False, 0, 1
    for m in _TOKEN.finditer(raw):
        word, number, code, sign, brace, plain = m.groups()
        if brace == "{":
            stack.append((hidden, uc))
        elif brace == "}":
            hidden, uc = stack.pop() if stack else (False, 1)
        elif word:
            if word in _SKIPPED:
                hidden = True
            elif word == "uc":
                uc = int(number or 1)
            elif word == "u" and not hidden:
                out.append(chr(int(number or 0) % 65536))
                skip_chars = uc
            elif word in _MARKS and not hidden:
                out.append(_MARKS[word])
        elif sign == "*":
            hidden = True
        elif hidden:
            continue
        elif code:
            if skip_chars:
                skip_chars -= 1
            else:
                out.append(bytes([int(code, 16)]).decode("cp1252", "replace"))
        elif sign:
            out.append({"~": "\u00a0", "_": "-", "-": "\u00ad"}.get(sign, sign if sign in "\\{}" else ""))
        elif plain:
            out.append(plain[skip_chars:])
            skip_chars = max(0, skip_chars - len(plain))
    return "".join(out)


def reports(spark: SparkSession, path: str, pattern: str = "*.rtf") -> DataFrame:
    """``source_file``, ``report_year``, ``text`` of the RTF reports of a folder; the year is the first 20xx of the file's name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    schema = "source_file string, report_year int, text string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            names = [p.rsplit("/", 1)[-1] for p in pdf["path"]]
            years = [int(m.group()) if (m := re.search(r"20\d\d", n.rsplit(".", 1)[0])) else None for n in names]
            yield pd.DataFrame({"source_file": names, "report_year": pd.array(years, dtype="Int32"), "text": [rtf_text(bytes(c).decode("utf-8", "replace")) for c in pdf["content"]]})

    return files.select("path", "content").mapInPandas(run, schema)


def register(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A register in CSV: all fields text, absent columns null, extra ones passed over, a byte-order mark ignored."""
    found = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").csv(path)
    have = {c.lstrip("\ufeff"): c for c in found.columns}
    return found.select(*[(F.col(f"`{have[c]}`") if c in have else F.lit(None)).cast("string").alias(c) for c in columns])


def geocoded(spark: SparkSession, path: str) -> DataFrame:
    """``project_id``, ``lat``, ``lon``, ``tier`` from a JSON object keyed by project."""
    kind = T.MapType(T.StringType(), T.StructType([T.StructField("geo_lat", T.DoubleType()), T.StructField("geo_lon", T.DoubleType()), T.StructField("geo_tier", T.StringType())]))
    raw = spark.read.text(path, wholetext=True)
    each = raw.select(F.explode(F.from_json("value", kind)).alias("project_id", "g"))
    return each.select("project_id", F.col("g.geo_lat").alias("lat"), F.col("g.geo_lon").alias("lon"), F.col("g.geo_tier").alias("tier"))


def numbered_texts(spark: SparkSession, path: str) -> DataFrame:
    """``source_file``, ``report_year``, ``text`` of texts written with line numbers: numbers stripped, white space squeezed."""
    raw = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("source_file"), "value")
    year = F.nullif(F.regexp_extract("source_file", r"(20\d\d)", 1), F.lit("")).try_cast("int")
    return raw.select("source_file", year.alias("report_year"), F.trim(F.regexp_replace(F.regexp_replace("value", r"(?m)^\s*\d+  ", ""), r"(?U)\s+", " ")).alias("text"))


def word_list(spark: SparkSession, path: str | None) -> DataFrame:
    """Ordinary words in lower case from a word list; none without a path."""
    if path is None:
        return spark.createDataFrame([], "word string")
    return spark.read.text(path).select(F.trim("value").alias("word")).where(F.col("word").rlike(r"^\p{Ll}")).distinct()


def year_of(name) -> object:
    """The first 20xx of a file's name, null if none."""
    return F.nullif(F.regexp_extract(name, r"(20\d\d)", 1), F.lit("")).try_cast("int")


def xlsx_rows(content: bytes, sheet: str | None = None) -> list[list[str | None]]:
    """Rows of text of a workbook's sheet, the first by default; cells left out are null."""
    main, rel = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}", "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
    text = lambda node: "".join(t.text or "" for t in node.iter(f"{main}t"))
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = {s.get("name"): s.get(f"{rel}id") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{main}sheet")}
        if sheet is not None and sheet not in names:
            raise ValueError(f"no sheet {sheet}")
        target = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}[names[sheet] if sheet is not None else next(iter(names.values()))]
        shared = [text(x) for x in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
        rows = []
        for row in ElementTree.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}")).iter(f"{main}row"):
            cells: list[str | None] = []
            for c in row.iter(f"{main}c"):
                letters = re.match("[A-Z]+", c.get("r") or "")
                at = sum((ord(x) - 64) * 26**i for i, x in enumerate(reversed(letters.group()))) - 1 if letters else len(cells)
                cells += [None] * (at - len(cells))
                value = c.find(f"{main}v")
                kind = c.get("t")
                cells.append(text(c) if kind == "inlineStr" else None if value is None else shared[int(value.text)] if kind == "s" else value.text)
            rows.append(cells)
        return rows


def sheets(spark: SparkSession, path: str, columns: list[str], sheet: str | None = None) -> DataFrame:
    """``columns`` of a sheet of each workbook under ``path``, as text, by the header in its first row; absent columns are null."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for content in pdf["content"]:
                header, *rows = xlsx_rows(bytes(content), sheet) or [[]]
                at = [header.index(c) if c in header else None for c in columns]
                yield pd.DataFrame([[r[i] if i is not None and i < len(r) else None for i in at] for r in rows], columns=columns, dtype=object)

    return files.mapInPandas(run, ", ".join(f"`{c}` string" for c in columns))
