"""Roll-ups of mentions, entries and registers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Kilowatts of a unit.
UNIT_KW = {"W": 0.001, "kW": 1.0, "MW": 1000.0, "GW": 1e6}


def project_years(mentions: DataFrame) -> DataFrame:
    """Resolved mentions by project and year: count, terms, countries and sections in first-seen order, the first 20 lines, the best example.

    ``mentions``: ``project_id``, ``report_year``, ``doc_id``, ``a``, ``term``, ``reporting_country``, ``section``,
    ``section_kind``, ``line``, ``resolution``, ``context``, ``source_file``. The example is of a sure term before others,
    of a section with a kind before others, then the first.
    """
    keys = ["project_id", "report_year"]
    m = mentions.where("project_id is not null")
    order = F.struct("doc_id", "a")
    sure, told = (F.col("resolution") != "unique term").cast("int"), F.col("section_kind").isNull().cast("int")
    whole = m.groupBy(*keys).agg(F.count("*").alias("n_mentions"), F.min_by("context", F.struct(sure.alias("s"), told.alias("t"), "doc_id", "a")).alias("example_context"), F.min_by("source_file", order).alias("source_file"))
    # each different value once, so that no group's mentions are collected
    kinds = {"terms_matched": "term", "reporting_countries": "reporting_country", "sections": "section"}
    each = m.select(*keys, order.alias("o"), F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("v")) for k, c in kinds.items()])).alias("x"))
    seen = each.where("x.v is not null and (x.k <> 'sections' or x.v <> '')").groupBy(*keys, F.col("x.k").alias("k"), F.col("x.v").alias("v")).agg(F.min("o").alias("o"))
    listed = lambda k: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("k") == k, F.struct("o", "v")))), lambda x: x["v"]), "; ")
    values = seen.groupBy(*keys).agg(*[listed(k).alias(k) for k in kinds])
    first = m.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id", "a"))).where("_r <= 20")
    lines = first.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "line"))), lambda x: x["line"].cast("string")), "; ").alias("lines"))
    out = whole.join(values, keys, "left").join(lines, keys)
    return out.select(*keys, "n_mentions", *[F.coalesce(k, F.lit("")).alias(k) for k in kinds], "lines", "example_context", "source_file")


def recall(found: DataFrame, verified: DataFrame) -> DataFrame:
    """One row: verified pairs found, all verified pairs, per cent (half to even), found pairs not verified. Both have the same key columns."""
    keys = verified.columns
    v, f = verified.distinct(), found.select(*keys).distinct()
    both = v.withColumn("_v", F.lit(1)).join(f.withColumn("_f", F.lit(1)), keys, "full")
    hit, n = F.count_if(F.col("_v").isNotNull() & F.col("_f").isNotNull()), F.count_if(F.col("_v").isNotNull())
    return both.agg(hit.alias("n_found"), n.alias("n_verified"), F.bround(100 * hit / F.greatest(n, F.lit(1)), 0).cast("int").alias("percent"), F.count_if(F.col("_v").isNull()).alias("n_extra"))


def site_summary(sites: DataFrame, mentions: DataFrame) -> DataFrame:
    """Every site with its mentions, reports, years and countries; sites without mentions are kept. Most mentioned first."""
    g = mentions.groupBy("site_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("report_year")).alias("y"), F.array_sort(F.collect_set("reporting_country")).alias("l"))
    none = F.array()
    y = F.coalesce("y", none.cast("array<int>"))
    out = sites.join(g, "site_id", "left").select(
        "site_id", "site_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_mentions"), F.size(y).cast("bigint").alias("n_reports"), F.array_min(y).alias("first_year"), F.array_max(y).alias("last_year"),
        F.array_join(F.transform(y, lambda v: v.cast("string")), ", ").alias("years_mentioned"), F.array_join(F.coalesce("l", none.cast("array<string>")), "; ").alias("reporting_countries"),
    )
    return out.orderBy(F.desc("n_mentions"), "site_name", "site_id")


def country_years(mentions: DataFrame, entries: DataFrame, chapters: DataFrame) -> DataFrame:
    """Cells of year and country from three sources in one aggregate: no outer joins.

    ``mentions``: ``report_year``, ``country``, ``site_id``, ``site_name``; ``entries``: ``report_year``, ``country``,
    ``signal_score``, ``has_capacity``; ``chapters``: ``report_year``, ``country``.
    """
    null = lambda t: F.lit(None).cast(t)
    a = mentions.select("report_year", "country", "site_id", "site_name", null("int").alias("signal_score"), null("boolean").alias("has_capacity"), F.lit("m").alias("src"))
    b = entries.select("report_year", "country", null("string").alias("site_id"), null("string").alias("site_name"), "signal_score", "has_capacity", F.lit("e").alias("src"))
    c = chapters.select("report_year", "country", null("string").alias("site_id"), null("string").alias("site_name"), null("int").alias("signal_score"), null("boolean").alias("has_capacity"), F.lit("c").alias("src"))
    e = F.col("src") == "e"
    return a.unionByName(b).unionByName(c).groupBy("report_year", "country").agg(
        F.when(F.bool_or(F.col("src") == "c"), "yes").otherwise("no").alias("country_chapter_found"), F.count_distinct("site_id").alias("n_test_sites"), F.count_if(F.col("src") == "m").alias("n_test_site_mentions"),
        F.count_if(e).alias("n_projects"), F.count_if(e & (F.col("signal_score") >= 2)).alias("n_projects_signal_2plus"), F.count_if(e & F.col("has_capacity")).alias("n_projects_with_capacity"),
        F.count_if(e & ~F.col("has_capacity")).alias("n_projects_without_capacity"), F.array_join(F.array_sort(F.collect_set("site_name")), "; ").alias("test_sites"),
    )


def ordered_refs(df: DataFrame, key: str, refs: str, target: DataFrame, target_key: str, value: str) -> DataFrame:
    """``key`` and the ``value`` of each referenced record in list order; unknown references are passed over."""
    each = df.select(key, F.posexplode(refs).alias("_pos", target_key))
    met = each.join(target.select(target_key, value), target_key)
    return met.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", F.col(value).alias("v")))), lambda x: x["v"]).alias(value))


def filled_capacity(df: DataFrame, key: str, sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """``key``, ``capacity_kw``, ``source``: the largest value of the first source that has a readable one; values of zero or less are dropped after the choice.

    Each source: ``key``, ``value`` (text), ``unit``.
    """
    table = F.create_map(*[F.lit(x) for pair in UNIT_KW.items() for x in pair])
    rows = None
    for i, (name, s) in enumerate(sources):
        kw = F.col("value").cast("string").try_cast("double") * F.try_element_at(table, F.col("unit"))
        part = s.select(key, F.lit(i).alias("i"), F.lit(name).alias("source"), kw.alias("kw")).where("kw is not null")
        rows = part if rows is None else rows.unionByName(part)
    best = rows.groupBy(key, "i", "source").agg(F.max("kw").alias("kw")).groupBy(key).agg(F.min_by(F.struct("source", "kw"), "i").alias("b"))
    good = F.col("b.kw") > 0
    return df.select(key).join(best, key, "left").select(key, F.when(good, F.col("b.kw")).alias("capacity_kw"), F.when(good, F.col("b.source")).alias("source"))


def first_position(*places: tuple[str, Column, Column]) -> Column:
    """(lat, lon, basis) of the first place that has both coordinates."""
    return F.coalesce(*[F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.cast("double").alias("lat"), lon.cast("double").alias("lon"), F.lit(name).alias("basis"))) for name, lat, lon in places])


def first_example(df: DataFrame, keys: list[str], value: str, preferred: Column, order: list[str]) -> DataFrame:
    """``keys``, count and the first ``value`` in ``order``, preferred rows first."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.min_by(value, F.struct((~F.coalesce(preferred, F.lit(False))).cast("int").alias("p"), *order)).alias("example"))


def chapter_counts(found: DataFrame, listed: DataFrame) -> DataFrame:
    """Counts per (project_id, year), at least 1 where the year is listed without a mention."""
    g = found.groupBy("project_id", "year").agg(F.count("*").alias("n"))
    both = g.unionByName(listed.select("project_id", "year", F.lit(0).cast("bigint").alias("n")))
    return both.groupBy("project_id", "year").agg(F.greatest(F.sum("n"), F.lit(1)).cast("bigint").alias("n"))


def shared_records(df: DataFrame, name: str) -> DataFrame:
    """Adds ``n_shared``: how many rows use the same ``name``; counted before the join, so a hot name is no hot window."""
    g = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n_shared"))
    return df.join(g, name, "left")


def names_with_sources(df: DataFrame) -> DataFrame:
    """``name``, ``country``, ``n``, ``sources``: how often and where a name occurs (``name``, ``country``, ``source``)."""
    return df.groupBy("name", "country").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("source")), "; ").alias("sources"))


def appended(df: DataFrame, key: str, fields: list[str], order: str) -> DataFrame:
    """Non-empty values of several records of a key, joined by `` | `` in order, per field."""
    pick = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.coalesce(F.col(c), F.lit("")) != "", F.struct(F.col(order).alias("o"), F.col(c).alias("v"))))), lambda x: x["v"]), " | ")
    return df.groupBy(key).agg(*[pick(c).alias(c) for c in fields])


def status_with_fallback(status: Column, year: Column, other: Column) -> Column:
    """A status with its latest year, else the outside source's status."""
    return F.coalesce(F.when(F.coalesce(status, F.lit("")) != "", F.concat(status, F.when(year.isNotNull(), F.concat(F.lit(" ("), year.cast("string"), F.lit(")"))).otherwise(""))), F.nullif(other, F.lit("")))


def linked_projects(df: DataFrame) -> DataFrame:
    """Per ``site_id`` its projects by first year, then name."""
    return df.groupBy("site_id").agg(F.array_sort(F.collect_list(F.struct("first_year", "name", "ranges"))).alias("projects"))


def sequential_ids(df: DataFrame, order: list[str], prefix: str = "P", width: int = 4, after: int = 0) -> DataFrame:
    """Adds ``new_id``: numbers in the order of ``order``, without one task for all rows.

    Rows are range-partitioned; each partition's count, a number per task, tells where the next begins.
    """
    from ..session import cut_lineage

    parts = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_p": F.spark_partition_id(), "_m": F.monotonically_increasing_id()}))
    counts = sorted((r["_p"], r["n"]) for r in parts.groupBy("_p").agg(F.count("*").alias("n")).collect())
    start, table = after, []
    for p, n in counts:
        table.append((p, start))
        start += n
    firsts = df.sparkSession.createDataFrame(table, "_p int, _s bigint")
    inside = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))  # a row's place in its partition
    numbered = parts.join(F.broadcast(firsts), "_p").withColumn("_n", F.col("_s") + inside + 1)
    return numbered.withColumn("new_id", F.concat(F.lit(prefix), F.lpad(F.col("_n").cast("string"), width, "0"))).drop("_p", "_m", "_s", "_n")


def overridden(df: DataFrame, corrections: DataFrame, key: str) -> DataFrame:
    """``df`` with the non-null fields of hand corrections (one row a ``key``) in place of its own; unknown keys are passed over."""
    fields = [c for c in corrections.columns if c != key and c in df.columns]
    fixes = corrections.select(key, *[F.col(c).alias(f"_fix_{c}") for c in fields])
    joined = df.join(fixes, key, "left")
    return joined.select(*[F.coalesce(f"_fix_{c}", c).alias(c) if c in fields else F.col(c) for c in df.columns])
