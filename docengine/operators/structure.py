"""Document structure: lines, chapters, sections, blocks and entries. Windows are per document, never global."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions import text as T, vocab
from ..functions.rx import uni
from ..session import cut_lineage

LOOKAHEAD, ISOLATION = 10, 15
BULLETS = ("•", "", "-", "–", "▪", "●")


def _doc() -> WindowSpec:
    return Window.partitionBy("doc_id").orderBy("line_no")


def lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``line_no`` (from 0), ``line``: the cleaned lines of each document. No shuffle; null texts have none."""
    return docs.select("doc_id", F.posexplode(T.clean_lines(F.col(text))).alias("line_no", "line"))


def tag_headings(rows: DataFrame, sections: tuple = vocab.SECTIONS) -> DataFrame:
    """Adds ``is_heading``, ``heading``, ``kind`` of the line itself; a test-site table's head counts as a heading."""
    table = F.upper("line").contains("TEST SITE NAME")
    s = rows.withColumn("_s", T.section_of(F.col("line"), sections))
    return s.select(
        *rows.columns,
        (F.col("_s.is_heading") | table).alias("is_heading"),
        F.when(table, "Test site table").otherwise(F.col("_s.heading")).alias("heading"),
        F.when(table, "test sites").otherwise(F.col("_s.kind")).alias("kind"),
    )


def chapter_candidates(rows: DataFrame, countries: dict[str, str] = vocab.COUNTRIES) -> DataFrame:
    """Lines that may open a country's chapter: the name alone (also over two lines), a marker within the next lines."""
    table = F.create_map(*[F.lit(x) for pair in countries.items() for x in pair])
    h = rows.withColumn("_h", F.lower(T.normalise_heading(F.col("line"))))
    own = F.try_element_at(table, F.col("_h"))
    wrapped = F.try_element_at(table, F.trim(F.concat_ws(" ", "_h", F.lead("_h").over(_doc()))))
    named = h.select("doc_id", "line_no", F.coalesce(own, wrapped).alias("country"), F.when(own.isNotNull(), 1).otherwise(2).alias("_skip")).where("country is not null")
    # only the few named lines look ahead
    after = h.select("doc_id", F.col("line_no").alias("_at"), "_h", F.upper("line").contains("TEST SITE NAME").alias("_table"))
    ahead = named.join(after, "doc_id").where("_at >= line_no + _skip and _at < line_no + _skip + " + str(LOOKAHEAD))
    marker, author = uni(vocab.CHAPTER_MARKER, True), uni(vocab.AUTHOR_MARKER, True)
    marks, first = F.col("_h").rlike(marker), F.col("_at") == F.col("line_no") + F.col("_skip")
    keys = [F.lit(c) for c in countries]
    found = ahead.groupBy("doc_id", "line_no", "country").agg(
        F.bool_or(marks).alias("_marked"), F.bool_or(marks & F.col("_h").rlike(author)).alias("has_author"),
        F.bool_or(first & F.col("_h").isin(*keys)).alias("_listed"), F.bool_or(F.col("_table") & (F.col("_at") < F.col("line_no") + F.col("_skip") + 3)).alias("_sites"),
    )
    return found.where("_marked and not _listed and not _sites").select("doc_id", "line_no", "country", "has_author")


def isolated(candidates: DataFrame, distance: int = ISOLATION) -> DataFrame:
    """Candidates without another country's candidate nearby; both of a close pair go."""
    near = Window.partitionBy("doc_id").orderBy("line_no").rangeBetween(-(distance - 1), distance - 1)
    return candidates.withColumn("_c", F.size(F.collect_set("country").over(near))).where("_c = 1").drop("_c")


def best_per_country(candidates: DataFrame, n_lines: DataFrame) -> DataFrame:
    """Of several candidates of a country the one with an author line, then the longest span, then the first."""
    w = Window.partitionBy("doc_id").orderBy("line_no")
    spans = candidates.join(n_lines, "doc_id").withColumn("_span", F.coalesce(F.lead("line_no").over(w), F.col("n_lines")) - F.col("line_no"))
    rank = Window.partitionBy("doc_id", "country").orderBy(F.desc("has_author"), F.desc("_span"), "line_no")
    return spans.withColumn("_r", F.row_number().over(rank)).where("_r = 1").select("doc_id", "line_no", "country", "n_lines")


def chapters(rows: DataFrame, countries: dict[str, str] = vocab.COUNTRIES) -> DataFrame:
    """``doc_id``, ``start``, ``end`` (half-open), ``country``, ``author``: country chapters up to the next one or the back matter."""
    n = rows.groupBy("doc_id").agg(F.max("line_no").alias("m")).select("doc_id", (F.col("m") + 1).alias("n_lines"))
    starts = cut_lineage(best_per_country(isolated(chapter_candidates(rows, countries)), n))  # few rows, read twice
    w = Window.partitionBy("doc_id").orderBy("line_no")
    starts = starts.withColumn("end", F.coalesce(F.lead("line_no").over(w), F.col("n_lines")))
    s = starts.select("doc_id", F.col("line_no").alias("start"), "end", "country")
    # only documents with a chapter are read on
    h = rows.join(s.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("_h", T.normalise_heading(F.col("line")))
    h = h.withColumns({"_back": F.col("_h").rlike(uni(vocab.BACK_MATTER, True)), "_after": F.collect_list("_h").over(_doc().rowsBetween(1, 3))})
    inside = h.join(s, "doc_id").where("line_no > start and line_no < end")
    author = uni(r"^(authors?|report prepared by)", True)
    stop = inside.groupBy("doc_id", "start").agg(
        F.min(F.when(F.col("_back"), F.col("line_no"))).alias("back"),
        F.min(F.when(F.col("_h").rlike(author) & (F.col("line_no") <= F.col("start") + LOOKAHEAD), F.struct("line_no", "_h", "_after"))).alias("a"),
    )
    rest = F.regexp_replace(F.col("a._h"), uni(r"^(authors?(\s*\(s\))?|report prepared by)\s*:?\s*", True), "")
    names = F.filter(F.col("a._after"), lambda x: ~x.rlike(uni(vocab.CHAPTER_MARKER, True)))
    listed = F.when(rest != "", F.concat(F.array(rest), F.slice(names, 1, 2))).otherwise(F.slice(names, 1, 3))
    end = F.least("end", F.coalesce("back", "end"))
    known = F.col("a").isNotNull() & (F.col("a.line_no") < end)
    out = s.join(stop, ["doc_id", "start"], "left")
    return out.select("doc_id", "start", end.alias("end"), "country", F.when(known, F.regexp_replace(F.array_join(listed, "; "), "^[; ]+|[; ]+$", "")).otherwise("").alias("author"))


def tag_chapters(rows: DataFrame, chaps: DataFrame) -> DataFrame:
    """Adds ``country``: the chapter a line stands in, blank outside. The last start is carried forward; no range join."""
    marks = chaps.select("doc_id", F.col("start").alias("line_no"), F.struct("end", "country").alias("_m"))
    carried = F.last("_m", ignorenulls=True).over(_doc().rowsBetween(Window.unboundedPreceding, 0))
    out = rows.join(marks, ["doc_id", "line_no"], "left").withColumn("_m", carried)
    return out.withColumn("country", F.when(F.col("line_no") < F.col("_m.end"), F.col("_m.country")).otherwise("")).drop("_m")


def carry_sections(rows: DataFrame, project_kinds: tuple = vocab.PROJECT_KINDS) -> DataFrame:
    """Adds ``section`` and ``section_kind``: the last heading's, reset where ``country`` changes.

    A test-site heading inside a project section keeps the section's kind. ``rows`` has ``country`` and the columns of
    ``tag_headings``.
    """
    turn = F.coalesce((F.col("country") != F.lag("country").over(_doc())).cast("int"), F.lit(1))
    run = rows.withColumn("_run", F.sum(turn).over(_doc()))
    w = Window.partitionBy("doc_id", "_run").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("is_heading"), F.struct("heading", "kind")), ignorenulls=True).over(w)
    other = F.last(F.when(F.col("is_heading") & ~F.coalesce(F.col("kind") == "test sites", F.lit(False)), F.struct("kind")), ignorenulls=True).over(w)
    run = run.withColumns({"_c": last, "_l": other})
    kind = F.when((F.col("_c.kind") == "test sites") & F.col("_l.kind").isin(*project_kinds), F.col("_l.kind")).otherwise(F.col("_c.kind"))
    return run.withColumns({"section": F.coalesce("_c.heading", F.lit("")), "section_kind": kind}).drop("_run", "_c", "_l")


def blocks(rows: DataFrame, wanted: Column) -> DataFrame:
    """Adds ``block``: numbers of the contiguous runs of ``wanted`` lines, cut at headings, which belong to none, and where a chapter (``country``) ends.

    Only lines of blocks are returned.
    """
    inside = F.coalesce(wanted, F.lit(False)) & ~F.col("is_heading")
    marked = rows.withColumn("_in", inside)
    turn = F.coalesce(F.col("country") != F.lag("country").over(_doc()), F.lit(False)) if "country" in rows.columns else F.lit(False)
    starts = (F.col("_in") & (turn | ~F.coalesce(F.lag("_in").over(_doc()), F.lit(False)))).cast("int")
    return marked.withColumn("block", F.sum(starts).over(_doc())).where("_in").drop("_in")


def typical_length(block_lines: DataFrame) -> DataFrame:
    """``typical``: the median length of a block's lines over 20 characters, 60 if there are none."""
    long = F.when(F.length("line") > 20, F.length("line"))
    return block_lines.groupBy("doc_id", "block").agg(F.coalesce(F.median(long), F.lit(60.0)).alias("typical"))


def is_title(line: Column, before: Column, after: Column, typical: Column) -> Column:
    """Whether a line titles what follows: short, mostly capitalised words, no end mark, followed by body text."""
    s = T.strip(line)
    words = F.split(s, uni(r"\s+"))
    caps = F.size(F.filter(words, lambda w: w.rlike(r'^[A-Z0-9("]')))
    prior = F.rtrim(F.coalesce(before, F.lit("")))
    return F.coalesce(
        (s != "") & (F.length(s) <= F.least(F.lit(70.0), typical * 0.7)) & (F.size(words) <= 10) & ~s.rlike(r"[.,;:-]$") & s.rlike(r'^[A-Z0-9"(]')
        & ~s.rlike(uni(vocab.FURNITURE, True)) & (caps / F.size(words) >= 0.5)
        & ~s.rlike(uni(vocab.CAPTIONS, True))
        & after.isNotNull() & (F.length(T.strip(after)) >= 25) & (before.isNull() | prior.rlike(r"[.!?:)]$") | (F.length(T.strip(before)) < 40)),
        F.lit(False),
    )


def entries(block_lines: DataFrame) -> DataFrame:
    """``doc_id``, ``block``, ``entry``, ``title``, ``line_start``, ``line_end``, ``text``: a block's lines parted into entries.

    A title begins an entry, a bullet or a new paragraph an untitled one; lone bullets are skipped, entries without a body
    dropped. Where an entry begins depends on the line before, so it is a running sum and no loop.
    """
    w = Window.partitionBy("doc_id", "block").orderBy("line_no")
    long = F.when(F.length("line") > 20, F.length("line"))
    x = block_lines.withColumn("typical", F.coalesce(F.median(long).over(Window.partitionBy("doc_id", "block")), F.lit(60.0)))
    x = x.withColumns({"_p": F.lag("line").over(w), "_n": F.lead("line").over(w)})
    x = x.withColumn("_title", is_title(F.col("line"), F.col("_p"), F.col("_n"), F.col("typical"))).where(~T.strip(F.col("line")).isin(*BULLETS))
    x = x.withColumn("_pk", F.lag("_title").over(w))
    bullet = F.col("line").rlike(uni(r"^\s*[•▪●►]\s*"))
    end = F.rtrim("_p")
    para = F.coalesce(end.rlike(r"[.!?]$") & (F.length("_p") < 0.75 * F.col("typical")) & F.col("line").rlike(uni(r'^\s*[A-Z0-9"]')), F.lit(False))
    begins = F.col("_title") | F.col("_pk").isNull() | (bullet & ~F.col("_pk")) | (~F.col("_pk") & para)
    x = x.withColumn("entry", F.sum(begins.cast("int")).over(w))
    body = F.regexp_replace("line", uni(r"^\s*[•▪●►]\s*"), "")
    g = x.groupBy("doc_id", "block", "entry").agg(
        F.max(F.when(F.col("_title"), T.strip(F.col("line")))).alias("title"),
        F.array_sort(F.collect_list(F.when(~F.col("_title"), F.struct("line_no", body.alias("t"))))).alias("b"),
        F.first("section", ignorenulls=True).alias("section") if "section" in block_lines.columns else F.lit("").alias("section"),
        F.first("section_kind", ignorenulls=True).alias("section_kind") if "section_kind" in block_lines.columns else F.lit("").alias("section_kind"),
        F.first("country").alias("country") if "country" in block_lines.columns else F.lit("").alias("country"),
    )
    return g.where("size(b) > 0").select(
        "doc_id", "block", "entry", F.coalesce("title", F.lit("")).alias("title"), (F.get("b", F.lit(0))["line_no"] + 1 - F.when(F.col("title").isNotNull(), 1).otherwise(0)).alias("line_start"),
        (F.element_at("b", -1)["line_no"] + 1).alias("line_end"), T.join_lines(F.col("b.t")).alias("text"), "section", "section_kind", "country",
    )


def offsets(rows: DataFrame) -> DataFrame:
    """Adds ``start``: where a line begins in the document's joined text (lines joined by one blank)."""
    before = F.sum(F.length("line") + 1).over(_doc().rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("start", F.coalesce(before, F.lit(0)).cast("bigint"))


def _as_one(lines: Column) -> list[Column]:
    """``text`` and ``starts`` of an array of lines."""
    starts = F.aggregate(lines, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("s")), lambda a, x: F.struct((a["at"] + F.length(x) + 1).alias("at"), F.concat(a["s"], F.array(a["at"])).alias("s")), lambda a: a["s"])
    return [F.array_join(lines, " ").alias("text"), starts.alias("starts")]


def joined(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (lines joined by one blank), ``starts`` (where each line begins)."""
    g = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    return g.select("doc_id", *_as_one(F.col("l.line")))


def joined_documents(docs: DataFrame, *columns: str) -> DataFrame:
    """``joined`` of the ``lines`` of ``docs``, with their ``columns`` kept. One document a row, so nothing is moved."""
    cleaned = docs.select("doc_id", *columns, T.clean_lines(F.col("text")).alias("l")).where("size(l) > 0")
    return cleaned.select("doc_id", *columns, *_as_one(F.col("l")))


def line_of(starts: Column, offset: Column) -> Column:
    """The line (from 0) an offset of the joined text lies in."""
    return F.size(F.filter(starts, lambda s: s <= offset)) - 1


def context(text: Column, a: Column, b: Column, width: int = 160) -> Column:
    """What surrounds a span, cut at sentence ends where there are any."""
    left, right = F.substr(text, F.greatest(a - width, F.lit(0)) + 1, F.least(a, F.lit(width))), F.substr(text, b + 1, F.lit(width))
    inner = F.substr(text, a + 1, b - a)
    cut_left = F.regexp_replace(left, r"(?s)^.*\. ", "")
    stop = F.instr(right, ". ")
    return T.strip(F.concat(cut_left, inner, F.when(stop > 0, F.substr(right, F.lit(1), stop)).otherwise(right)))
