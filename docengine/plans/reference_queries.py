"""Queries of the document and register operators, each over its whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import text as T, vocab
from ..functions.missing import is_missing, key_lower, key_upper, present, trimmed
from ..operators import extract, facets, gazetteer, packed, resolve, spans, structure, summarize, terms
from ..session import cut_lineage, spread
from . import sample_reports


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def big(*names: str) -> list:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"))


def docs_and_reports(spark: SparkSession, d: str) -> DataFrame:
    """The documents, and a few reports with country chapters under ids below zero, as the table itself has none."""
    made = spark.createDataFrame([(-i, t) for i, t in sample_reports.TEXTS], "doc_id bigint, text string")
    return docs(spark, d).select("doc_id", "text").unionByName(made)


# --- text and structure


def doc_lines(spark, d):
    return structure.lines(docs(spark, d)).select(*big("doc_id", "line_no"), F.length("line").cast("bigint").alias("n_chars"), "line")


def heading_tags(spark, d):
    return structure.tag_headings(structure.lines(docs(spark, d))).where("is_heading").select(*big("doc_id", "line_no"), "heading", F.coalesce("kind", F.lit("")).alias("kind"))


def section_carry_forward(spark, d):
    rows = structure.tag_headings(structure.lines(docs(spark, d))).withColumn("country", F.lit(""))
    return structure.carry_sections(rows).where("section <> ''").select(*big("doc_id", "line_no"), "section", F.coalesce("section_kind", F.lit("")).alias("section_kind"))


def document_chapters(spark, d):
    found = structure.chapters(structure.lines(docs_and_reports(spark, d)))
    return found.select(*big("doc_id"), F.col("start").cast("bigint").alias("first_line"), F.col("end").cast("bigint").alias("end_line"), "country", "author")


def tagged_lines(spark, d):
    rows = cut_lineage(structure.lines(docs_and_reports(spark, d)))  # four consumers
    tagged = structure.tag_headings(structure.tag_chapters(rows, structure.chapters(rows)))
    return structure.carry_sections(tagged)


def chapter_lines(spark, d):
    return tagged_lines(spark, d).groupBy("doc_id", "country").agg(F.count("*").alias("n_lines"), F.count_if(F.col("section") != "").alias("n_in_section"))


def chapter_sections(spark, d):
    """Lines in a section of a country's chapter; sections end where the chapter does."""
    return tagged_lines(spark, d).where("country <> '' and section <> ''").select(*big("doc_id", "line_no"), "country", "section", F.coalesce("section_kind", F.lit("")).alias("section_kind"))


def blocks_runs(spark, d):
    rows = structure.tag_headings(structure.lines(docs(spark, d)))
    b = structure.blocks(rows, F.length("line") > 40)
    return b.groupBy("doc_id", "block").agg(F.min("line_no").cast("bigint").alias("first_line"), F.count("*").alias("n_lines")).select(*big("doc_id", "block", "first_line", "n_lines"))


def line_stats_median(spark, d):
    rows = structure.lines(docs(spark, d)).withColumn("block", F.lit(1))
    return structure.typical_length(rows).select(*big("doc_id"), F.col("typical").cast("double").alias("typical"))


def joined_offsets(spark, d):
    return structure.offsets(structure.lines(docs(spark, d))).select(*big("doc_id", "line_no", "start"))


def hyphen_join(spark, d):
    return docs(spark, d).select("doc_id", T.join_lines(T.clean_lines(F.col("text"))).alias("text")).where("text is not null and text <> ''")


def _entries(tagged):
    return structure.entries(structure.blocks(extract.mode_of_chapter(tagged), F.col("wanted")))


def document_entries(spark, d):
    return _entries(tagged_lines(spark, d))


def site_lines(x, index):
    """``doc_id``, ``line_no`` of the lines of documents ``x`` a site's mention begins in; mentions may run over lines."""
    whole = structure.joined_documents(x)
    found = spans.scan_any(whole, index, "longest").join(whole.select("doc_id", "starts"), "doc_id")
    return found.select("doc_id", structure.line_of(F.col("starts"), F.col("a")).alias("line_no")).distinct()


def project_rows(spark, d):
    places = table(spark, d, "test_sites").select(F.explode(extract.registered_places(present(F.col("location")))).alias("place"))
    e = cut_lineage(extract.emit(_entries(tagged_lines(spark, d)), site_lines(docs_and_reports(spark, d), gazetteer.alias_index(sites(spark, d)))))
    e = extract.describe(extract.known_places(e, places, ["doc_id", "block", "entry"]))
    join = lambda c: F.array_join(c, "; ").alias(c)
    return e.select("doc_id", "line_start", "line_end", "title", "name_guess", *[join(c) for c in ("technologies", "capacities", "status", "years", "places", "water_bodies", "countries", "coordinates", "depths", "offshore", "entities")], "signal_score", "method", "text")


def clipped_text(spark, d):
    return docs(spark, d).where("text is not null").select("doc_id", T.clip(F.col("text"), 80).alias("clip"))


# --- attributes


def _joined(c):
    return F.array_join(c, "; ")


def attr_capacities(spark, d):
    return docs(spark, d).select("doc_id", _joined(extract.capacities(F.col("text"))).alias("capacities")).where("capacities <> ''")


def attr_labels(spark, d):
    t = F.col("text")
    return docs(spark, d).where("text is not null").select("doc_id", _joined(extract.labels(t, vocab.TECHNOLOGIES)).alias("technologies"), _joined(extract.labels(t, vocab.STATUS)).alias("status"))


def attr_years(spark, d):
    return docs(spark, d).select("doc_id", _joined(extract.years(F.col("text"))).alias("years")).where("years <> ''")


def signal_scores(spark, d):
    return docs(spark, d).where("text is not null").select("doc_id", extract.signal_score(F.col("text"), F.lit(False)).cast("bigint").alias("signal_score"))


def named_entities(spark, d):
    return docs(spark, d).select("doc_id", _joined(extract.named_entities(F.col("text"))).alias("entities")).where("entities <> ''")


def place_phrases(spark, d):
    t = F.col("text")
    found = docs(spark, d).select("doc_id", extract.places(t).alias("p"), extract.countries(t).alias("c"), extract.coordinates(t).alias("x"), extract.depths(t).alias("z"), extract.offshore(t).alias("o"))
    return found.select("doc_id", *[_joined(F.col(a)).alias(b) for a, b in (("p", "places"), ("c", "countries"), ("x", "coordinates"), ("z", "depths"), ("o", "offshore"))])


# --- dictionaries


def sites(spark, d) -> DataFrame:
    s = table(spark, d, "test_sites")
    listed = packed.unpack(s.select("site_id", present(F.col("aliases")).alias("value")).where("value is not null")).groupBy("site_id").agg(F.collect_list("value").alias("listed"))
    names = F.array_distinct(F.concat(F.array("name"), F.coalesce("listed", F.array().cast("array<string>"))))
    return s.select("site_id", present(F.col("name")).alias("name"), present(F.col("country")).alias("country")).join(listed, "site_id", "left").where("name is not null").select("site_id", "name", "country", names.alias("aliases"))


def mentions(spark, d) -> DataFrame:
    return gazetteer.site_mentions(docs(spark, d).where("text is not null"), cut_lineage(gazetteer.alias_index(sites(spark, d))))  # read by the scan and for the owners


def site_mentions(spark, d):
    return mentions(spark, d)


def mention_contexts(spark, d):
    m = mentions(spark, d).join(docs(spark, d).select("doc_id", "text"), "doc_id")
    return m.select("doc_id", "a", "b", "term", "site_id", structure.context(F.col("text"), F.col("a"), F.col("b")).alias("context"))


def mentioned_sites(spark, d):
    """The summary of sites over the mentions found in the documents."""
    m = mentions(spark, d).join(docs(spark, d).select("doc_id", "report_year", F.coalesce("reporting_country", F.lit("")).alias("reporting_country")), "doc_id")
    return summarize.site_summary(sites(spark, d).select("site_id", F.col("name").alias("site_name")), m)


def site_candidates(spark, d):
    x = docs(spark, d).where("text is not null")
    found = gazetteer.candidates(x, mentions(spark, d)).join(x.select("doc_id", "report_year", F.coalesce("reporting_country", F.lit("")).alias("reporting_country")), "doc_id")
    return gazetteer.candidate_summary(found)


def candidate_phrases(spark, d):
    return gazetteer.candidates(docs(spark, d).where("text is not null")).groupBy(F.lower("name").alias("name")).agg(F.count("*").alias("n"))


def _projects(spark, d) -> DataFrame:
    p = table(spark, d, "projects")
    return p.select(key_upper(F.col("project_id")).alias("project_id"), "row_id", *[present(F.col(c)).alias(c) for c in ("name", "country", "reporting_country", "search_terms", "test_site_id", "device", "aliases", "category")])


def _terms(spark, d) -> DataFrame:
    return gazetteer.project_terms(_projects(spark, d).where("project_id is not null and search_terms is not null"))


def search_terms(spark, d):
    return _terms(spark, d).select("project_id", "term", "is_weak")


def _resolved(spark, d, x) -> DataFrame:
    """The projects' terms found in texts ``x``, with the project each is decided for."""
    t = cut_lineage(_terms(spark, d))  # by the scan, for owners and cues
    of = _projects(spark, d).where("project_id is not null").groupBy("project_id").agg(F.max("country").alias("country"), F.max("reporting_country").alias("reporting_country"), F.max(key_lower(F.col("test_site_id"))).alias("site_id"))
    of = cut_lineage(of)
    cues = of.join(sites(spark, d).select("site_id", F.explode("aliases").alias("cue")), "site_id").select("project_id", "cue")
    return gazetteer.resolve(gazetteer.project_mentions(x, t), x, t, of.drop("site_id"), cues)


def project_mentions(spark, d):
    return _resolved(spark, d, docs(spark, d).where("text is not null"))


def mentioned_project_years(spark, d):
    """Projects by year, from mentions in the cleaned lines, each with its line and section."""
    own = docs(spark, d).select("doc_id", "text", "report_year", F.coalesce("reporting_country", F.lit("")).alias("reporting_country"), "source_file")
    whole = cut_lineage(structure.joined_documents(own, "report_year", "reporting_country", "source_file"))  # by the scan, for surroundings and lines
    m = _resolved(spark, d, whole).join(whole, "doc_id").withColumns({"line_no": structure.line_of(F.col("starts"), F.col("a")), "context": structure.context(F.col("text"), F.col("a"), F.col("b"))})
    m = m.join(tagged_lines(spark, d).select("doc_id", "line_no", "section", "section_kind"), ["doc_id", "line_no"]).withColumn("line", F.col("line_no") + 1)
    return summarize.project_years(m)


def term_hits(spark, d):
    h = gazetteer.term_hits(docs(spark, d).where("text is not null"), _terms(spark, d).select("term").distinct())
    return h.select("term", "n_hits", F.array_join(F.transform("years", lambda y: y.cast("string")), ", ").alias("years"))


def fuzzy_match_tiers(spark, d):
    c = table(spark, d, "test_site_candidates").select(F.col("candidate_id").alias("name_id"), present(F.col("candidate")).alias("name"), present(F.col("country")).alias("country")).where("name is not null")
    return resolve.match_tiers(c, sites(spark, d))


def proposed_terms(spark, d):
    """Terms proposed for each project, and why one is none: site names and ordinary words are those of the tables."""
    p = _projects(spark, d).where("project_id is not null")
    one = p.groupBy("project_id").agg(*[F.max(c).alias(c) for c in ("name", "aliases", "device")])
    got = terms.proposed(one, {"name": F.array("name"), "aliases": F.split(F.coalesce("aliases", F.lit("")), r" \| "), "device": F.array("device")})
    lands = F.array(*[F.lit(c) for c in sorted(set(vocab.COUNTRIES.values()))])
    ordinary = F.array(*[F.lit(r["word"]) for r in table(spark, d, "common_words").select("word").distinct().orderBy("word").collect()])  # a fixed table
    told = got.withColumn("reason", terms.drop_reason(F.col("term"), countries=lands, common=ordinary))
    return terms.named_as_sites(told, sites(spark, d).select(F.explode("aliases").alias("alias"))).select("project_id", "term", "field", "reason")


def pruned_terms(spark, d):
    got = cut_lineage(proposed_terms(spark, d).where("reason = ''"))
    hits = cut_lineage(gazetteer.term_hits(docs(spark, d).where("text is not null"), got.select("term").distinct()))
    places = F.array(*[F.lit(w) for w in sorted({w.lower() for r in vocab.REGIONS for w in r.split()})])
    kept = terms.busy_places(got, hits, terms.is_place_term(F.col("term"), places)).where("reason = ''").drop("reason")
    told = terms.flags(kept, hits, terms.is_place_term(F.col("term"), places), name_owners=False)  # only whether there is a flag counts
    return terms.prune(told).select("project_id", F.array_join("terms", " | ").alias("terms"))


# --- register roll-ups


def _years(col: str):
    return F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(r"\d{4}"), F.lit(0))


def site_summary(spark, d):
    s = table(spark, d, "test_sites").select(key_lower(F.col("site_id")).alias("site_id"), F.coalesce(present(F.col("name")), F.lit("")).alias("site_name"))
    m = table(spark, d, "projects").select(key_lower(F.col("test_site_id")).alias("site_id"), trimmed(F.col("first_seen")).try_cast("int").alias("report_year"), F.coalesce(present(F.col("reporting_country")), F.lit("")).alias("reporting_country"))
    out = summarize.site_summary(s, m.where("site_id is not null"))
    return out.select("site_id", "site_name", *big("n_mentions", "n_reports", "first_year", "last_year"), "years_mentioned", "reporting_countries")


def observed(spark, d) -> DataFrame:
    """Observations each ``projects`` row cites, in list order."""
    p = table(spark, d, "projects").select("row_id", key_upper(F.col("project_id")).alias("project_id"), F.posexplode(F.regexp_extract_all(F.upper(F.coalesce("obs_ids", F.lit(""))), F.lit(r"OB\d+"), F.lit(0))).alias("pos", "obs_id"))
    o = table(spark, d, "observations").groupBy(key_upper(F.col("obs_id")).alias("obs_id")).agg(F.min_by(F.struct("report_year", "reporting_country", "evidence"), F.struct("loaded_at", "evidence", "report_year")).alias("o"))
    return p.join(o, "obs_id").select("row_id", "project_id", "pos", "obs_id", trimmed(F.col("o.report_year")).try_cast("int").alias("report_year"), F.coalesce(present(F.col("o.reporting_country")), F.lit("")).alias("reporting_country"), F.coalesce("o.evidence", F.lit("")).alias("evidence"))


def project_years(spark, d):
    o = observed(spark, d).where("project_id is not null and report_year is not null").select(
        "project_id", "report_year", F.col("row_id").alias("doc_id"), F.col("pos").alias("a"), F.col("obs_id").alias("term"), "reporting_country", F.lit("").alias("section"), F.lit(None).cast("string").alias("section_kind"),
        F.col("pos").alias("line"), F.when(F.col("evidence") != "", "unique term").otherwise("context").alias("resolution"), F.col("evidence").alias("context"), F.lit("").alias("source_file"),
    )
    return summarize.project_years(o).select("project_id", *big("report_year", "n_mentions"), "terms_matched", "reporting_countries", "lines", "example_context")


def recall_check(spark, d):
    found = observed(spark, d).where("project_id is not null and report_year is not null").select("project_id", F.col("report_year").cast("string").alias("year"))
    p = table(spark, d, "projects").where("report_years_basis = 'Pilot observations'").select(key_upper(F.col("project_id")).alias("project_id"), F.explode(_years("report_years")).alias("year")).where("project_id is not null")
    return summarize.recall(found, p).select(*big("n_found", "n_verified", "percent", "n_extra"))


def country_years(spark, d):
    land = lambda c: F.coalesce(F.lower(present(F.col(c))), F.lit(""))
    s = table(spark, d, "test_sites").select(key_lower(F.col("site_id")).alias("site_id"), F.coalesce(present(F.col("name")), F.lit("")).alias("site_name"), land("country").alias("country"))
    p = table(spark, d, "projects")
    year = trimmed(F.col("first_seen")).try_cast("int").alias("report_year")
    m = p.select(year, key_lower(F.col("test_site_id")).alias("site_id")).where("site_id is not null").join(s, "site_id")
    e = p.select(year, land("country").alias("country"), F.when(~is_missing(F.col("latest_status")), 2).otherwise(1).alias("signal_score"), (~is_missing(F.col("capacity_kw"))).alias("has_capacity"))
    c = table(spark, d, "observations").select(trimmed(F.col("report_year")).try_cast("int").alias("report_year"), land("reporting_country").alias("country"))
    out = summarize.country_years(m, e, c)
    counts = [c for c in out.columns if c.startswith("n_")]
    return out.select(*big("report_year", *counts), "country", "country_chapter_found", "test_sites")


def filled_capacity(spark, d):
    p = table(spark, d, "projects").select("row_id", F.explode(F.regexp_extract_all(F.upper(F.coalesce("pilot_project_id", F.lit(""))), F.lit(r"PIL\d+"), F.lit(0))).alias("pilot_id"))
    pilot = table(spark, d, "pilot_projects").select(key_upper(F.col("project_id")).alias("pilot_id"), F.col("capacity_max_value").alias("value"), F.col("capacity_max_unit").alias("unit"))
    own = table(spark, d, "projects").select("row_id", F.col("capacity_kw").alias("value"), F.lit("kW").alias("unit"))
    out = summarize.filled_capacity(table(spark, d, "projects"), "row_id", [("pilot", p.join(pilot, "pilot_id").select("row_id", "value", "unit")), ("own", own)])
    return out.where("capacity_kw is not null").select(*big("row_id"), F.round("capacity_kw", 6).alias("capacity_kw"), "source")


def filled_position(spark, d):
    real = lambda c, most: F.when(F.abs(trimmed(F.col(c)).try_cast("double")) <= most, trimmed(F.col(c)).try_cast("double"))
    s = table(spark, d, "test_sites").select(key_lower(F.col("site_id")).alias("k"), real("lat", 90).alias("s_lat"), real("lon", 180).alias("s_lon"))
    p = table(spark, d, "projects").select("row_id", key_lower(F.col("test_site_id")).alias("k"), real("lat", 90).alias("p_lat"), real("lon", 180).alias("p_lon"))
    at = summarize.first_position(("test site", F.col("s_lat"), F.col("s_lon")), ("project", F.col("p_lat"), F.col("p_lon")))
    return p.join(s, "k", "left").select("row_id", at.alias("x")).where("x is not null").select(*big("row_id"), "x.lat", "x.lon", "x.basis")


def year_ranges(spark, d):
    y = table(spark, d, "projects").select("row_id", F.transform(_years("report_years"), lambda v: v.cast("int")).alias("y"))
    return y.where("size(y) > 0").select(*big("row_id"), T.year_ranges(F.col("y")).alias("ranges"))


def _events(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.col("user_id").alias("doc_id"), F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("line_no"), F.col("event_type").alias("country"), (F.col("value") > 50).alias("has_author"))


def chapter_top1(spark, d):
    c = _events(spark, d)
    n = c.groupBy("doc_id").agg((F.max("line_no") + 1).alias("n_lines"))
    return structure.best_per_country(structure.isolated(c, 2), n).select(*big("doc_id", "line_no"), "country")


def owner_margin(spark, d):
    p = table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.sum("p_retailprice").alias("score"))
    w = Window.partitionBy("p_brand").orderBy(F.desc("score"), "p_type")
    r = p.withColumns({"_r": F.row_number().over(w), "second": F.lead("score").over(w)}).where("_r = 1")
    return r.select("p_brand", "p_type", F.round("score", 2).alias("score"), F.round(F.col("score") - F.coalesce("second", F.lit(0.0)), 2).alias("margin"))


def facet_counts(spark, d):
    p = table(spark, d, "projects").select(*[F.coalesce(present(F.col(c)), F.lit("")).alias(c) for c in ("country", "technology", "category")], F.coalesce(trimmed(F.col("capacity_kw")).try_cast("double"), F.lit(0.0)).alias("kw"))
    out = facets.facet_counts(p, {"country": ["United Kingdom", "France", "China"], "technology": ["wave", "tidal stream"], "category": None}, "kw")
    return out.select("facet", "value", *big("n"), F.round("total", 2).alias("total"))


def top_k_list(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", *big("l_linenumber"), "l_extendedprice").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(250)


def anti_link(spark, d):
    """Pilot records that no checked or reviewed project cites."""
    trusted = table(spark, d, "projects").where(F.lower(trimmed("review_status")).isin("checked", "reviewed"))
    cited = trusted.select(F.explode(F.regexp_extract_all(F.upper(F.coalesce("pilot_project_id", F.lit(""))), F.lit(r"PIL\d+"), F.lit(0))).alias("project_id"))
    return table(spark, d, "pilot_projects").select(key_upper(F.col("project_id")).alias("project_id"), "canonical_name").join(cited, "project_id", "left_anti")


def multi_ref_join(spark, d):
    p = table(spark, d, "projects").select("row_id", F.regexp_extract_all(F.upper(F.coalesce("pilot_project_id", F.lit(""))), F.lit(r"PIL\d+"), F.lit(0)).alias("refs"))
    t = table(spark, d, "pilot_projects").select(key_upper(F.col("project_id")).alias("pilot_id"), F.coalesce("canonical_name", F.lit("")).alias("canonical_name"))
    return summarize.ordered_refs(p, "row_id", "refs", t, "pilot_id", "canonical_name").select(*big("row_id"), F.array_join("canonical_name", " | ").alias("names"))


def prefer_then_first(spark, d):
    o = table(spark, d, "observations").where("evidence is not null").select(F.coalesce(present(F.col("reporting_country")), F.lit("")).alias("country"), F.coalesce(trimmed(F.col("report_year")), F.lit("")).alias("year"), "evidence", "obs_id", (~is_missing(F.col("printed_page"))).alias("paged"))
    return summarize.first_example(o, ["country", "year"], "evidence", F.col("paged"), ["obs_id", "evidence"]).select("country", "year", *big("n"), "example")


def coordinates_parsed(spark, d):
    t = table(spark, d, "test_sites").select("site_id", T.parse_coordinates(F.concat_ws(", ", F.coalesce("lat", F.lit("")), F.coalesce("lon", F.lit("")))).alias("c"))
    return t.select("site_id", "c.lat", "c.lon").where("lat <> ''")


def country_names(spark, d):
    return table(spark, d, "projects").select(T.canonical_country(F.col("country")).alias("country")).groupBy("country").agg(F.count("*").alias("n"))


def name_aliases(spark, d):
    c = table(spark, d, "test_site_candidates").where("candidate is not null")
    return c.select("candidate_id", T.acronym(F.col("candidate")).alias("acronym"), F.array_join(T.aliases_of(F.col("candidate")), " | ").alias("aliases"))


def site_slugs(spark, d):
    c = table(spark, d, "test_site_candidates").where("candidate is not null")
    base = T.slug_base(F.col("candidate"), T.norm(F.when(T.acronym(F.col("candidate")) != "", T.acronym(F.col("candidate"))).otherwise(T.without_brackets(F.col("candidate")))))
    n = F.row_number().over(Window.partitionBy("base").orderBy("candidate_id"))
    return c.select("candidate_id", base.alias("base")).withColumn("n", n).select("candidate_id", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat("base", F.lit("_"), F.col("n").cast("string"))).alias("slug"))


def chapter_counts(spark, d):
    found = observed(spark, d).where("project_id is not null and report_year is not null").select("project_id", F.col("report_year").alias("year"))
    listed = table(spark, d, "projects").select(key_upper(F.col("project_id")).alias("project_id"), F.explode(F.transform(_years("report_years"), lambda y: y.cast("int"))).alias("year")).where("project_id is not null")
    return summarize.chapter_counts(found, listed).select("project_id", *big("year", "n"))


def names_with_sources(spark, d):
    a = table(spark, d, "pilot_projects").select(present(F.col("test_site_name")).alias("name"), F.coalesce(present(F.col("deployment_country")), F.lit("")).alias("country"), F.lit("pilot").alias("source"))
    b = table(spark, d, "projects").select(present(F.col("test_site_name_raw")).alias("name"), F.coalesce(present(F.col("country")), F.lit("")).alias("country"), F.lit("projects").alias("source"))
    return summarize.names_with_sources(a.unionByName(b).where("name is not null")).select("name", "country", *big("n"), "sources")


def shared_records(spark, d):
    p = table(spark, d, "projects").select("row_id", present(F.col("primre_website")).alias("site"))
    return summarize.shared_records(p, "site").where("n_shared > 1").select(*big("row_id", "n_shared"), "site")


def numbered_records(spark, d):
    p = table(spark, d, "pilot_projects").select("project_id")
    return summarize.sequential_ids(p, ["project_id"], width=8).select("project_id", "new_id")


def site_projects(spark, d):
    p = table(spark, d, "projects").select(key_lower(F.col("test_site_id")).alias("site_id"), F.coalesce(trimmed(F.col("first_seen")), F.lit("")).alias("first_year"), F.coalesce(trimmed(F.col("name")), F.lit("")).alias("name"), F.lit("").alias("ranges")).where("site_id is not null").distinct()
    return summarize.linked_projects(p).select("site_id", F.size("projects").cast("bigint").alias("n"), F.array_join(F.transform("projects", lambda x: F.concat(x["first_year"], F.lit(" "), x["name"])), "; ").alias("projects"))


def status_texts(spark, d):
    p = table(spark, d, "projects").select("row_id", summarize.status_with_fallback(F.lower(present(F.col("latest_status"))), trimmed(F.col("last_seen")).try_cast("int"), F.coalesce(present(F.col("primre_status")), F.lit(""))).alias("status"))
    return p.where("status is not null").select(*big("row_id"), "status")


def technology_codes(spark, d):
    codes = F.create_map(*[F.lit(x) for pair in vocab.PILOT_TECH.items() for x in pair])
    t = table(spark, d, "pilot_projects").select(F.coalesce(F.try_element_at(codes, trimmed(F.col("technology"))), trimmed(F.col("technology")), F.lit("")).alias("technology"))
    return t.groupBy("technology").agg(F.count("*").alias("n"), F.count_if(F.col("technology") != "other").alias("n_in_scope"))


def map_filter(spark, d):
    """Projects a map shows, and how many each reason keeps out."""
    p = table(spark, d, "projects").select((F.lower(trimmed(F.coalesce("in_scope", F.lit("")))) == "yes").alias("scope"), (F.size(_years("report_years")) > 0).alias("named"), (~is_missing(F.col("capacity_kw"))).alias("cap"))
    return p.agg(F.count_if(F.expr("scope and named and cap")).alias("shown"), F.count_if(F.expr("not scope")).alias("out_of_scope"), F.count_if(F.expr("scope and not named")).alias("not_named"), F.count_if(F.expr("scope and named and not cap")).alias("no_capacity"))


def capacity_split(spark, d):
    p = table(spark, d, "projects")
    return p.groupBy((~is_missing(F.col("capacity_kw"))).cast("bigint").alias("with_capacity")).agg(F.count("*").alias("n"))


def spiral_layout(spark, d):
    s = facets.spiral(table(spark, d, "supplier"), ["s_nationkey"], ["-s_acctbal", "s_suppkey"])
    return s.select(*big("s_suppkey", "n"), F.round("dx", 6).alias("dx"), F.round("dy", 6).alias("dy"))


def colour_years(spark, d):
    chosen = F.array(*[F.lit(str(y)) for y in range(2012, 2020)])
    p = table(spark, d, "projects").select("row_id", _years("report_years").alias("y"))
    return p.select(*big("row_id"), facets.colour_year(F.col("y"), chosen, False).alias("first"), facets.colour_year(F.col("y"), chosen).alias("latest")).where("latest is not null")


def json_payload(spark, d):
    from ..sources import sinks

    return sinks.json_payload(table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name"), ["n_name"])


def queries() -> dict:
    names = """doc_lines heading_tags section_carry_forward document_chapters chapter_lines chapter_sections blocks_runs line_stats_median joined_offsets hyphen_join document_entries project_rows clipped_text attr_capacities attr_labels attr_years
    signal_scores named_entities place_phrases site_mentions mention_contexts mentioned_sites site_candidates candidate_phrases search_terms project_mentions mentioned_project_years term_hits fuzzy_match_tiers proposed_terms pruned_terms
    site_summary project_years recall_check country_years filled_capacity filled_position year_ranges chapter_top1 owner_margin facet_counts top_k_list anti_link multi_ref_join prefer_then_first coordinates_parsed country_names
    name_aliases site_slugs chapter_counts names_with_sources shared_records numbered_records site_projects status_texts technology_codes map_filter capacity_split spiral_layout colour_years json_payload""".split()
    return {n: globals()[n] for n in names}
