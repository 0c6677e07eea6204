import re

import pytest
from docengine.functions import text as T
from docengine.functions.rx import phrase, spans, uni
from pyspark.sql import functions as F


def one(spark, column, *values, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(column(F.col("v"))).collect()]


def test_characters_and_footers(spark):
    raw = "ﬁrst’s “x” y­z next\x0cpage 12 annual report 2015 tail"
    assert one(spark, lambda c: T.clean_lines(c), raw) == [["first's \"x\" yz", "next", "page", "tail"]]
    assert one(spark, T.clean_lines, "67DENMARKOVERVIEW\nbody", None, "", "  \n ") == [["DENMARK", "OVERVIEW", "body"], None, [], []]
    assert one(spark, T.clean_lines, "2013 ANNUAL REPORTITALY\nx") == [["ITALY", "x"]]


def test_headings(spark):
    got = one(spark, lambda c: T.section_of(c), "1.2 Projects in the Water:", "IV. OVERVIEW", "Open Sea Test Sites", "Some text", "", "x" * 90)
    assert [(r.is_heading, r.heading, r.kind) for r in got] == [(True, "Projects in the Water", "deployment"), (True, "OVERVIEW", None), (True, "Open Sea Test Sites", "test sites"), (False, "Some text", None), (False, "", None), (False, "x" * 90, None)]


def test_join_and_clip(spark):
    assert one(spark, T.join_lines, ["turbi-", "ne is"], ["Foo-", "Bar"], [], kind="array<string>") == ["turbine is", "Foo- Bar", ""]
    assert one(spark, lambda c: T.clip(c, 12), "short", "a b  c", "one two three four", "unbrokenlongword") == ["short", "a b c", "one two…", "unbrokenl…"]


def test_names(spark):
    assert one(spark, T.norm, "Île d'Yeu (TEST)", None, "Jennette's-Pier") == ["ile dyeu test", "", "jennettes pier"]
    assert one(spark, lambda c: T.core(T.norm(c)), "The National Wave Test Centre of Foo Foo") == ["wave foo foo"]
    assert one(spark, T.acronym, "Foo Bar (FB-1) x", "none", None) == ["FB-1", "", ""]
    assert one(spark, T.aliases_of, "The Foo Site (FST)", "Foo") == [["The Foo Site (FST)", "The Foo Site", "Foo Site", "FST"], ["Foo"]]
    assert one(spark, T.canonical_country, " south  korea", "Republic Of Korea", None) == ["Republic of Korea", "Republic of Korea", ""]
    assert one(spark, T.trim_generic, "Fair Head Phase 1", "Test Site", "Foo 110 kW") == ["Fair Head", "", "Foo"]
    assert one(spark, T.variants, "The SRNE 110 kW floating unit (SRNE-X) at Zhoushan") == [["SRNE 110 kW floating unit (SRNE-X) at Zhoushan", "SRNE-X", "SRNE 110 kW floating unit at Zhoushan", "SRNE 110 kW floating unit", "SRNE"]]
    assert one(spark, T.devices, "A/B, C ,D/E/F,") == [["B", "C", "F"]]


def test_coordinates(spark):
    got = one(spark, T.parse_coordinates, "29° 5' 55.86\", -13° 41' 4.99\"", "29.1", "29.1, -13.7", "a, b", None, "1, 2, 3")
    assert [(r.lat, r.lon) for r in got] == [("29.0988", "-13.6847"), ("", ""), ("29.1000", "-13.7000"), ("", ""), ("", ""), ("", "")]


def test_year_ranges(spark):
    assert one(spark, T.year_ranges, [2016, 2017, 2018, 2020], [], [2009, 2010, 2009], [1999, 2000], kind="array<int>") == ["2016–18, 2020", "", "2009–10", "1999–00"]


def test_formats(spark):
    assert one(spark, T.html_escape, "<a & \"b\">") == ["&lt;a &amp; &quot;b&quot;&gt;"]
    assert one(spark, T.power_text, 1.0, 250.0, 1500.0, kind="double") == ["1 kW", "250 kW", "1.5 MW"]
    assert one(spark, T.short_number, 600.0, 0.25, 1234567.0, 33.3333333, 0.0, kind="double") == ["600", "0.25", "1234570", "33.3333", "0"]
    assert one(spark, T.cell, "a\x00b\x1fc") == ["abc"]


@pytest.mark.parametrize("text", ["", "a 1 b22 c", "é12🙂3", "1", "x", "99 99"])
def test_spans_equal_finditer(spark, text):
    got = one(spark, lambda c: spans(c, uni(r"\d+")), text)[0]
    assert [(s.a, s.b, s.term) for s in got] == [(m.start(), m.end(), m.group()) for m in re.finditer(r"\d+", text)]


def test_phrases(spark):
    assert one(spark, lambda c: F.size(F.regexp_extract_all(c, F.lit(uni(phrase("WETS"))), F.lit(0))), "KRISO-WETS, xWETS, WETS.") == [1]
