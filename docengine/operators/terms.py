"""Search terms proposed for projects: candidates from their fields, reasons to drop them, flags, pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T, vocab
from ..functions.rx import uni

FREQUENT = 60


def _list(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def drop_reason(term: Column, site_aliases: Column | None = None, countries: Column | None = None, common: Column | None = None) -> Column:
    """Why a term is no search term, blank if it is one; the first reason counts.

    ``site_aliases``, ``countries``, ``common`` are arrays of names and of ordinary words in lower case.
    """
    none = F.array().cast("array<string>")
    generic, links = _list(vocab.TERM_GENERIC), _list(vocab.CONNECTORS)
    ws = T.words(term)
    bare = F.filter(ws, lambda w: ~F.array_contains(generic, F.regexp_replace(F.lower(w), r"^[.-]+|[.-]+$", "")))
    only = F.get(ws, F.lit(0))
    usual = common if common is not None else none
    parts = F.filter(F.split(F.lower(only), "[-/]"), lambda x: x != "")
    plain = lambda x: F.array_contains(usual, x) | F.array_contains(generic, x) | (x.endswith("s") & F.array_contains(usual, F.regexp_replace(x, "s$", "")))
    ordinary = (F.forall(parts, plain) | F.lower(only).isin(*vocab.EXTRA_ORDINARY)) & ~only.rlike(r".[A-Z]|\d")
    # The reasons as written.
    return (
        F.when((F.length(term) < 3) | (F.size(ws) == 0), "too short")
        .when(F.size(ws) > 6, "descriptive (long)")
        .when(~term.rlike("[A-Z0-9]"), "descriptive (lower-case)")
        .when(F.exists(F.slice(ws, 2, F.greatest(F.size(ws), F.lit(1))), lambda w: w.rlike(uni(r"^\p{Ll}")) & ~F.array_contains(links, w)), "descriptive (lower-case words)")
        .when(F.array_contains(site_aliases if site_aliases is not None else none, term), "test-site name")
        .when(F.array_contains(countries if countries is not None else none, term), "country name")
        .when(F.size(bare) == 0, "generic words only")
        .when((F.size(ws) == 1) & ordinary, "ordinary word")
        .otherwise("")
    )


def named_as_sites(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """``rows`` (``term``, ``reason``) with the reason of terms that are an alias (``alias``) of a test site, where none that counts before it has been found. A join, so any
    number of aliases may be known."""
    before = F.col("reason").startswith("too short") | F.col("reason").startswith("descriptive")
    known = aliases.select(F.col("alias").alias("term"), F.lit(True).alias("_site")).distinct()
    return rows.join(known, "term", "left").withColumn("reason", F.when(F.coalesce("_site", F.lit(False)) & ~before, "test-site name").otherwise(F.col("reason"))).drop("_site")


def busy_places(rows: DataFrame, hits: DataFrame, is_place: Column, frequent: int = FREQUENT) -> DataFrame:
    """``rows`` (``term``, ``reason``) with the reason of place names that occur more than ``frequent`` times, where there is no other."""
    busy = rows.join(hits.select("term", F.col("n_hits").alias("_n")), "term", "left")
    text = F.concat(F.lit("busy place name ("), F.col("_n").cast("string"), F.lit(" hits)"))
    return busy.withColumn("reason", F.when((F.col("reason") == "") & is_place & (F.coalesce("_n", F.lit(0)) > frequent), text).otherwise(F.col("reason"))).drop("_n")


def is_place_term(term: Column, place_words: Column) -> Column:
    """Whether every word is a known word of places, a generic word or a connector."""
    known = F.array_union(place_words, _list([*vocab.TERM_GENERIC, *vocab.CONNECTORS]))
    ws = T.words(term)
    return (F.size(ws) > 0) & F.forall(ws, lambda w: F.array_contains(known, F.lower(w)))


def proposed(projects: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """``project_id``, ``term``, ``field``: variants of every name in ``fields`` (arrays of names), each term once a project."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), c.alias("names")) for f, c in fields.items()])
    rows = projects.select("project_id", F.posexplode(each).alias("o", "x")).select("project_id", "o", "x.field", F.explode("x.names").alias("name")).where("name is not null and trim(name) <> ''")
    terms = rows.select("project_id", "o", "field", F.posexplode(T.variants(F.col("name"))).alias("i", "term"))
    return terms.groupBy("project_id", "term").agg(F.min_by("field", F.struct("o", "i")).alias("field"))


def flags(terms: DataFrame, hits: DataFrame, is_place: Column, frequent: int = FREQUENT, name_owners: bool = True) -> DataFrame:
    """Adds ``n_hits``, ``n_years``, ``flags``: shared with other projects, place name, frequent. Owners are counted once a term.

    Without ``name_owners`` a shared term is flagged ``shared`` alone: naming all owners to each takes rows and bytes that grow as
    the square of the projects that share a term.
    """
    owned = F.array_sort(F.collect_set("project_id")).alias("owners") if name_owners else F.count_distinct("project_id").alias("owners")
    t = terms.join(terms.groupBy("term").agg(owned), "term").join(hits.select("term", "n_hits", "years"), "term", "left")
    n = F.coalesce("n_hits", F.lit(0))
    shared = F.when(F.size("owners") > 1, F.concat(F.lit("shared with "), F.array_join(F.array_remove("owners", F.col("project_id")), ", "))) if name_owners else F.when(F.col("owners") > 1, "shared")
    text = F.concat_ws("; ", shared, F.when(is_place, "place name"), F.when(n > frequent, F.concat(F.lit("frequent ("), n.cast("string"), F.lit(")"))))
    return t.select(*terms.columns, n.cast("bigint").alias("n_hits"), F.coalesce(F.size("years"), F.lit(0)).alias("n_years"), text.alias("flags"))


def prune(flagged: DataFrame) -> DataFrame:
    """``project_id``, ``terms``: per project the terms with hits (the two shortest if none has), shortest first, without
    those that contain an unflagged one kept before."""
    g = flagged.groupBy("project_id").agg(F.array_sort(F.collect_list(F.struct(F.length("term").alias("l"), "term", "n_hits", "flags"))).alias("t"))
    hit = F.filter("t", lambda x: x["n_hits"] > 0)
    pool = F.when(F.size(hit) > 0, hit).otherwise(F.slice("t", 1, 2))
    word = lambda c: F.concat(F.lit(r"(?U)(?<![\w-])\Q"), c, F.lit(r"\E(?![\w-])"))
    kept = F.aggregate(pool, F.slice("t", 1, 0), lambda acc, x: F.when(F.exists(acc, lambda c: (c["flags"] == "") & F.regexp_like(x["term"], word(c["term"]))), acc).otherwise(F.concat(acc, F.array(x))))
    return g.select("project_id", F.transform(kept, lambda x: x["term"]).alias("terms"))


def taken_acronyms(names: DataFrame, existing: DataFrame) -> DataFrame:
    """``name`` and ``acronym``, blank where it occurs as a whole word of an existing alias (``alias``)."""
    n = names.select("name", T.acronym(F.col("name")).alias("acronym"))
    used = existing.select(F.explode(F.array_distinct(F.regexp_extract_all(F.col("alias"), F.lit(r"[A-Za-z][A-Za-z0-9-]{1,11}"), F.lit(0)))).alias("acronym")).distinct().withColumn("_used", F.lit(True))
    return n.join(used, "acronym", "left").select("name", F.when(F.col("_used"), "").otherwise(F.col("acronym")).alias("acronym"))
