import json
import zipfile

import pytest
from docengine.operators import structure
from docengine.sources import readers, sinks
from docengine.streaming import streams


def test_rtf(spark, tmp_path):
    rtf = r"{\rtf1\ansi{\fonttbl{\f0 Arial;}}{\*\generator x;}\pard First\'e9 line\par {\b bold} " + chr(92) + r"u8211? end\line {\pict 0102}Tab\tab x \{y\}}"
    assert readers.rtf_text(rtf) == "Firsté line\nbold – end\nTab\tx {y}"
    (tmp_path / "report 2014.rtf").write_text(rtf)
    (tmp_path / "none.rtf").write_text(r"{\rtf1 x}")
    got = {r.source_file: (r.report_year, r.text) for r in readers.reports(spark, str(tmp_path)).collect()}
    assert got == {"report 2014.rtf": (2014, "Firsté line\nbold – end\nTab\tx {y}"), "none.rtf": (None, "x")}


def test_register_with_mark_quotes_and_lines(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿site_id,name,extra\na,"x, ""y""\nz",1\nb,,2\n', encoding="utf-8")
    got = readers.register(spark, str(tmp_path / "r.csv"), ["site_id", "name", "absent"]).orderBy("site_id").collect()
    assert [tuple(r) for r in got] == [("a", 'x, "y"\nz', None), ("b", None, None)]


def test_json_and_numbered(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({"P1": {"geo_lat": 1.5, "geo_lon": 2, "geo_tier": "a"}}))
    assert [tuple(r) for r in readers.geocoded(spark, str(tmp_path / "g.json")).collect()] == [("P1", 1.5, 2.0, "a")]
    lines = structure.lines(spark.createDataFrame([(1, "one  two\nthree")], "doc_id bigint, text string"))
    text = sinks.numbered_lines(lines).first().text
    assert text == "     1  one two\n     2  three"
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "r2010.txt").write_text(text)
    assert [tuple(r) for r in readers.numbered_texts(spark, str(tmp_path / "n")).collect()] == [("r2010.txt", 2010, "one two three")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "x\x00, \"y\"", "FR"), ("b", None, "ES")], "k string, v string, country string")
    sinks.csv(df, str(tmp_path / "c"))
    assert sorted(tuple(r) for r in readers.register(spark, str(tmp_path / "c"), ["k", "v"]).collect()) == [("a", 'x, "y"'), ("b", None)]
    with pytest.raises(Exception):
        sinks.csv(df, str(tmp_path / "c"))
    sinks.by_country(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    payload = sinks.json_payload(df.select("k"), ["k"]).first().payload
    assert json.loads(payload) == [{"k": "a"}, {"k": "b"}]
    assert sinks.html_page("<script>@</script>", "@", '"</script>"') == '<script>"<\\/script>"</script>'
    (tmp_path / "w.xlsx").write_bytes(sinks.workbook({"One": df, "Two": df.limit(0)}))
    with zipfile.ZipFile(tmp_path / "w.xlsx") as z:
        assert z.testzip() is None and b"&quot;" not in z.read("xl/worksheets/sheet2.xml") and b"<row>" in z.read("xl/worksheets/sheet1.xml")
    with pytest.raises(ValueError):
        sinks.workbook({"One": df}, most_rows=1)


def test_stream_equals_batch(spark, tmp_path):
    docs = spark.createDataFrame([(1, "A 500 kW tidal turbine\nin 2010"), (2, None)], "doc_id bigint, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in"))
    for name, make, want in (("l", streams.stream_lines, structure.lines(docs)), ("x", streams.stream_attributes, streams.stream_attributes(docs))):
        q = make(live).writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
        q.awaitTermination()
        assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, want.collect()))
