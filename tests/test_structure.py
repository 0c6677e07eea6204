from docengine.operators import structure as S
from pyspark.sql import functions as F


def lines_of(spark, *texts):
    return S.lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def chapters(spark, text):
    return [(r.start, r.end, r.country, r.author) for r in S.chapters(lines_of(spark, text)).orderBy("start").collect()]


def test_chapters(spark):
    body = [f"body line {i} of the chapter with some words" for i in range(20)]
    text = "\n".join(["Contents", "DENMARK", "FRANCE", *body, "DENMARK", "Author: A. Person", "B. Other", "Overview", *body, "EUROPEAN", "COMMISSION", "INTRODUCTION", *body, "APPENDICES", *body])
    got = chapters(spark, text)
    assert [(c, a) for _, _, c, a in got] == [("Denmark", "A. Person; B. Other; body line 0 of the chapter with some words"), ("European Commission", "")]
    assert got[0][1] == got[1][0] and text.split("\n")[got[1][1]] == "APPENDICES"
    assert chapters(spark, "no chapter here") == []


def test_isolation_drops_both(spark):
    c = spark.createDataFrame([(1, 10, "a", True), (1, 15, "b", True), (1, 60, "a", False), (1, 90, "a", True)], "doc_id int, line_no int, country string, has_author boolean")
    assert sorted(r.line_no for r in S.isolated(c).collect()) == [60, 90]
    n = spark.createDataFrame([(1, 100)], "doc_id int, n_lines int")
    assert [r.line_no for r in S.best_per_country(S.isolated(c), n).collect()] == [90]


def carried(spark, rows):
    df = spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "doc_id int, line_no int, country string, is_heading boolean, heading string, kind string")
    return [(r.section, r.section_kind) for r in S.carry_sections(df).orderBy("line_no").collect()]


def test_carry(spark):
    rows = [
        ("", False, "", None), ("", True, "h1", "deployment"), ("", False, "", None), ("", True, "h2", "test sites"), ("", False, "", None), ("", True, "h3", None), ("", True, "h4", "test sites"),
        ("Spain", False, "", None), ("Spain", True, "h5", "test sites"), ("Spain", True, "h6", "planned"), ("Spain", True, "h7", "test sites"), ("Spain", True, "h8", "test sites"), ("France", False, "", None), ("", False, "", None),
    ]
    assert carried(spark, rows) == [
        ("", None), ("h1", "deployment"), ("h1", "deployment"), ("h2", "deployment"), ("h2", "deployment"), ("h3", None), ("h4", "test sites"),
        ("", None), ("h5", "test sites"), ("h6", "planned"), ("h7", "planned"), ("h8", "planned"), ("", None), ("", None),
    ]


LONG = "The body of an entry goes on for a while and fills its line to the very end"
ENTRIES = {
    "a title, its body, then a bullet": (["Big Device One", LONG, "• a further point of the list that stands alone", "and its second line"], [("Big Device One", 1, 2, LONG), ("", 3, 4, "a further point of the list that stands alone and its second line")]),
    "a paragraph after a short line that ends a sentence": ([LONG, "ends shortly.", "Another paragraph begins in here and is about as long as all others are"], [("", 1, 2, f"{LONG} ends shortly."), ("", 3, 3, "Another paragraph begins in here and is about as long as all others are")]),
    "no paragraph in lower case": ([LONG, "ends shortly.", "another line begins in lower case and is about as long as all others are"], [("", 1, 3, f"{LONG} ends shortly. another line begins in lower case and is about as long as all others are")]),
    "the first point below a title is its body": (["Small Array Two", "• the first point below a title belongs to that title", "• the second point is an entry of its own"], [("Small Array Two", 1, 2, "the first point below a title belongs to that title"), ("", 3, 3, "the second point is an entry of its own")]),
    "lone bullets are nothing": (["•", LONG, "–"], [("", 2, 2, LONG)]),
    "a title without a body is dropped": (["First Big Title", "Second Title Of That Block Here", LONG], [("Second Title Of That Block Here", 2, 3, LONG)]),
    "a caption is no title": (["Figure 3 Map", LONG], [("", 1, 2, f"Figure 3 Map {LONG}")]),
    "nor is a line that ends in a colon": (["The Sites Are:", LONG], [("", 1, 2, f"The Sites Are: {LONG}")]),
    "nor one of mostly small words": (["On the whole of it all", LONG], [("", 1, 2, f"On the whole of it all {LONG}")]),
    "nor one before a short line": (["Big Device One", "too short", LONG], [("", 1, 3, f"Big Device One too short {LONG}")]),
    "nor one inside a running sentence": ([LONG, "Big Device One", LONG], [("", 1, 3, f"{LONG} Big Device One {LONG}")]),
    "a hyphen at the end is joined": ([f"{LONG} turbi-", "ne is there"], [("", 1, 2, f"{LONG} turbine is there")]),
    "nothing": ([], []),
}


def test_entries(spark):
    rows = [(1, i, n, t) for i, (block, _) in enumerate(ENTRIES.values()) for n, t in enumerate(block)]
    got = {}
    for r in S.entries(spark.createDataFrame(rows, "doc_id int, block int, line_no int, line string")).orderBy("block", "line_start", "entry").collect():
        got.setdefault(r.block, []).append((r.title, r.line_start, r.line_end, r.text))
    for i, (name, (_, want)) in enumerate(ENTRIES.items()):
        assert got.get(i, []) == want, name


def test_blocks_and_offsets(spark):
    rows = S.tag_headings(lines_of(spark, "one long line of text\nOverview\ntwo long lines of text\nx\nthree long lines of text"))
    got = [(r.line_no, r.block) for r in S.blocks(rows, F.length("line") > 5).orderBy("line_no").collect()]
    assert got == [(0, 1), (2, 2), (4, 3)]
    off = [(r.line, r.start) for r in S.offsets(rows).orderBy("line_no").collect()]
    joined = S.joined(rows).first()
    assert all(joined.text[a : a + len(t)] == t for t, a in off) and joined.starts == [a for _, a in off]
    at = spark.createDataFrame([(joined.starts, 0), (joined.starts, 21), (joined.starts, 22), (joined.starts, 999)], "s array<int>, o int").select(S.line_of(F.col("s"), F.col("o"))).collect()
    assert [r[0] for r in at] == [0, 0, 1, 4]


def test_context(spark):
    text = "First sentence here. The Blue Head site is named. Another one follows."
    a = text.index("Blue")
    got = spark.createDataFrame([(text, a, a + 9), (text[4:], 0, 5)], "t string, a int, b int").select(S.context(F.col("t"), F.col("a"), F.col("b"))).collect()
    assert got[0][0] == "The Blue Head site is named." and got[1][0].startswith("t sen")


def test_empty(spark):
    none = lines_of(spark, None, "", " ")
    assert none.count() == 0 and S.chapters(none).count() == 0
    tagged = S.carry_sections(S.tag_headings(S.tag_chapters(none, S.chapters(none))))
    assert tagged.count() == 0 and S.entries(S.blocks(tagged, F.lit(True))).count() == 0


def test_results_do_not_depend_on_partitions(spark):
    from docengine.plans.reference_queries import project_rows

    got = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(sorted(map(str, project_rows(spark, "/root/testdata/sf0.001").collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1] and got[0]


def test_documents_joined_in_place_are_as_their_lines_joined(spark):
    """A document's lines as one text without a shuffle: as their lines gathered again, with nulls and texts without lines."""
    d = spark.createDataFrame([(1, "One\n\n  Two words\n12\nThree"), (2, None), (3, ""), (4, "x\r\ny"), (5, "\n\n")], "doc_id bigint, text string")
    rows = lambda df: sorted((r.doc_id, r.text, r.starts) for r in df.collect())
    got = S.joined_documents(d)
    assert rows(got) == rows(S.joined(S.lines(d))) and "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
