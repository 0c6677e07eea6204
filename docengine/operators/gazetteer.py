"""Dictionary mentions of sites and projects, candidates missing from the dictionary, and their resolution from context."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text as T, vocab
from ..functions.rx import spans as rx_spans, uni
from ..session import cut_lineage
from . import spans

CONTEXT = 600


def alias_index(sites: DataFrame) -> DataFrame:
    """``term``, ``owners`` (array of site_id, country in first-seen order): the aliases (array) of sites, shared ones once."""
    each = sites.select("site_id", F.coalesce("country", F.lit("")).alias("country"), F.explode("aliases").alias("term"))
    return each.select("site_id", "country", spans.squeezed(F.col("term")).alias("term")).where("term <> ''").groupBy("term").agg(F.array_sort(F.collect_set(F.struct("site_id", "country"))).alias("owners"))


def site_mentions(docs: DataFrame, index: DataFrame, land: str = "reporting_country") -> DataFrame:
    """``doc_id``, ``a``, ``b``, ``term``, ``site_id``: longest aliases first; a shared alias goes to the site in the document's country, else the first."""
    found = spans.scan_any(docs, index, "longest")
    at = found.join(docs.select("doc_id", F.coalesce(land, F.lit("")).alias("_land")), "doc_id").join(index, "term")
    here = F.get(F.filter("owners", lambda o: o["country"] == F.col("_land")), F.lit(0))
    return at.select("doc_id", "a", "b", "term", F.coalesce(here, F.get("owners", F.lit(0)))["site_id"].alias("site_id"))


def project_terms(projects: DataFrame) -> DataFrame:
    """``project_id``, ``term``, ``is_weak``, ``ord`` from ``search_terms`` (joined by |, weak ones marked ~); each term once."""
    each = projects.select("project_id", F.posexplode(F.split("search_terms", r"\|")).alias("ord", "raw"))
    each = each.select("project_id", "ord", T.squeeze(F.col("raw")).alias("raw")).where("raw <> ''")
    t = each.select("project_id", "ord", F.trim(F.regexp_replace("raw", "^~+", "")).alias("term"), F.col("raw").startswith("~").alias("is_weak")).where("term <> ''")
    return t.groupBy("project_id", "term").agg(F.max("is_weak").alias("is_weak"), F.min("ord").alias("ord"))


def project_mentions(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc_id``, ``a``, ``b``, ``term``: leftmost matches of all projects' terms."""
    return spans.scan_any(docs, terms, "leftmost")


def resolve(mentions: DataFrame, docs: DataFrame, terms: DataFrame, projects: DataFrame, cues: DataFrame | None = None, width: int = CONTEXT, land: str = "reporting_country") -> DataFrame:
    """Adds ``project_id`` (null if unresolved) and ``resolution`` to ``mentions``.

    A term of one project that is not weak is sure. Else each owner scores by its other cues within ``width`` characters and
    half a point for the document's country; the best wins if it has a cue and leads. ``cues``: ``project_id``, ``cue``
    beyond the terms (aliases of the project's site); ``projects``: ``project_id``, ``country``, ``reporting_country``.
    """
    once = mentions.select("doc_id", "a", "b", "term")
    owners = terms.groupBy("term").agg(F.count_distinct("project_id").alias("n"), F.max("is_weak").alias("weak"), F.min("project_id").alias("only"))
    known = once.join(owners, "term")
    sure = known.where("n = 1 and not weak").select("doc_id", "a", "b", "term", F.col("only").alias("project_id"), F.lit("unique term").alias("resolution"))
    unsure = known.where("n > 1 or weak").select("doc_id", "a", "b", "term", "n")
    unsure = cut_lineage(unsure.withColumn("_m", F.xxhash64("doc_id", "a", "b", "term")))  # read for the cues and for those without one
    around = F.substr("text", F.greatest(F.col("a") - width, F.lit(0)) + 1, F.col("b") + width - F.greatest(F.col("a") - width, F.lit(0)))
    texts = unsure.join(docs.select("doc_id", "text", F.coalesce(land, F.lit("")).alias("_land")), "doc_id").select("_m", "term", "_land", around.alias("text"))
    every = terms.select("project_id", F.col("term").alias("cue"))
    every = (every if cues is None else every.unionByName(cues.select("project_id", "cue"))).select("project_id", spans.squeezed(F.col("cue")).alias("cue")).where("cue <> ''").distinct()
    # a project that owns an unsure term: its other cues. Every surrounding is read once for all cues, whoever owns them
    asked = cut_lineage(terms.join(owners.where("n > 1 or weak").select("term"), "term").select("term", "project_id").join(every, "project_id").where("cue <> term"))
    told = spans.scan_any(texts.select("_m", "text"), asked.select(F.col("cue").alias("term")).distinct(), "all", "_m").select("_m", F.col("term").alias("cue")).distinct()
    hits = told.join(texts.select("_m", "term", "_land"), "_m").join(asked, ["term", "cue"])
    scored = hits.groupBy("_m", "_land", "project_id").agg(F.array_sort(F.collect_set("cue")).alias("_hits")).join(projects.select("project_id", "country", "reporting_country"), "project_id", "left")
    at_home = (F.col("_land") != "") & (F.coalesce(F.col("_land") == F.col("country"), F.lit(False)) | F.coalesce(F.col("_land") == F.col("reporting_country"), F.lit(False)))
    label = F.array_join(F.when(at_home, F.concat("_hits", F.array(F.concat(F.lit("chapter "), "_land")))).otherwise(F.col("_hits")), ", ")
    scored = scored.select("_m", "project_id", (F.size("_hits") + F.when(at_home, 0.5).otherwise(0.0)).alias("_score"), label.alias("_label"))
    two = scored.withColumn("_r", F.row_number().over(Window.partitionBy("_m").orderBy(F.desc("_score"), F.desc("project_id")))).where("_r <= 2")
    best = two.groupBy("_m").agg(F.max(F.when(F.col("_r") == 1, F.struct("_score", "project_id", "_label"))).alias("_b"), F.max(F.when(F.col("_r") == 2, F.col("_score"))).alias("_second"))
    won = F.coalesce(F.col("_b._score") > F.coalesce("_second", F.lit(0.0)), F.lit(False))
    decided = F.when(won, F.concat(F.lit("context: "), "_b._label")).when(F.col("n") > 1, "ambiguous").otherwise("weak term, no context")
    loose = unsure.join(best, "_m", "left").select("doc_id", "a", "b", "term", F.when(won, F.col("_b.project_id")).alias("project_id"), decided.alias("resolution"))
    return sure.unionByName(loose)


def candidates(docs: DataFrame, claimed: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``a``, ``b``, ``name``: phrases that look like test sites and overlap no claimed span; leading filler words go."""
    lead = uni(r"^((" + "|".join([*vocab.CANDIDATE_LEAD, *sorted(vocab.COUNTRIES, key=lambda c: (-len(c), c))]) + r")\s+)+", True)
    found = docs.select("doc_id", F.explode(rx_spans(F.col("text"), uni(vocab.CANDIDATE))).alias("s")).select("doc_id", "s.a", "s.b", F.regexp_replace(F.regexp_replace("s.term", lead, ""), "^[ ,.;:]+|[ ,.;:]+$", "").alias("name"))
    if claimed is not None:
        found = spans.not_overlapping(found, claimed)
    fit = (F.size(F.split(T.strip(F.col("name")), uni(r"\s+"))) >= 2) & F.col("name").rlike("^[A-Z]") & ~((F.upper("name") == F.col("name")) & F.contains("name", F.lit("TEST SITE")))
    return found.where(fit)


def candidate_summary(found: DataFrame, years: str = "report_year", land: str = "reporting_country") -> DataFrame:
    """Candidates by name, case apart: the most usual spelling (the first seen of equals), counts, years, countries."""
    per = found.groupBy(F.lower("name").alias("k"), "name").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "a")).alias("first"), F.collect_set(years).alias("y"), F.collect_set(land).alias("l"))
    g = per.groupBy("k").agg(F.max_by("name", F.struct("n", (-F.col("first.doc_id")).alias("d"), (-F.col("first.a")).alias("a"))).alias("candidate"), F.sum("n").alias("n_mentions"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("y")))).alias("y"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("l")))).alias("l"))
    return g.select("candidate", "n_mentions", F.array_join(F.transform("y", lambda y: y.cast("string")), ", ").alias("years_mentioned"), F.array_join(F.filter("l", lambda x: x != ""), "; ").alias("reporting_countries"))


def term_hits(docs: DataFrame, terms: DataFrame, year: str = "report_year") -> DataFrame:
    """``term``, ``n_hits``, ``years``: how often each distinct term occurs as a whole phrase, every occurrence counted, 0 kept."""
    found = spans.scan_any(docs, terms, "all").join(docs.select("doc_id", F.col(year).alias("_y")), "doc_id")
    g = found.groupBy("term").agg(F.count("*").alias("n_hits"), F.array_sort(F.collect_set("_y")).alias("years"))
    return terms.select("term").distinct().join(g, "term", "left").select("term", F.coalesce("n_hits", F.lit(0)).cast("bigint").alias("n_hits"), F.coalesce("years", F.array().cast("array<int>")).alias("years"))
