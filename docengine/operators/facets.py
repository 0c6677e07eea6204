"""Faceted counts, map layout and geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

GOLDEN_ANGLE = 2.39996


def facet_counts(df: DataFrame, facets: dict[str, list | None], measure: str | None = None) -> DataFrame:
    """``facet``, ``value``, ``n``, ``total``: rows that pass all facets but the counted one, by its values, in one scan.

    ``facets``: chosen values by column, None for all. ``measure`` is summed.
    """
    passes = {c: F.lit(True) if v is None else F.coalesce(F.col(c).isin(*v), F.lit(False)) for c, v in facets.items()}
    cells = []
    for c in facets:
        others = F.lit(True)
        for o, p in passes.items():
            others = others & p if o != c else others
        cells.append(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"), others.alias("ok")))
    amount = F.coalesce(F.col(measure), F.lit(0.0)) if measure else F.lit(0.0)
    long = df.select(amount.alias("m"), F.explode(F.array(*cells)).alias("c")).select("m", "c.*")
    return long.groupBy("facet", "value").agg(F.count_if("ok").alias("n"), F.sum(F.when(F.col("ok"), F.col("m")).otherwise(0.0)).alias("total"))


def colour_year(years: Column, chosen: Column, latest: bool = True) -> Column:
    """The latest or first of the chosen years a record has, null if none."""
    both = F.array_intersect(years, chosen)
    return F.array_max(both) if latest else F.array_min(both)


def example_choice(examples: Column, chosen: Column) -> Column:
    """Of (year, text) the latest chosen year with a text, else the latest of all."""
    told = F.transform(F.filter(examples, lambda e: e["text"].isNotNull()), lambda e: F.struct(F.array_contains(chosen, e["year"]).cast("int").alias("c"), e["year"].alias("year"), e["text"].alias("text")))
    return F.array_max(told)["text"]


def spiral(df: DataFrame, place: list[str], order: list[str], step: float = 6.0) -> DataFrame:
    """Adds ``n`` (from 0), ``dx``, ``dy``: records of one place laid on a golden-angle spiral, the first in its middle."""
    n = F.row_number().over(Window.partitionBy(*place).orderBy(*[F.desc(o[1:]) if o[0] == "-" else F.col(o) for o in order])) - 1
    out = df.withColumn("n", n)
    r, angle = F.lit(step) * F.sqrt("n"), F.col("n") * GOLDEN_ANGLE
    return out.withColumns({"dx": r * F.cos(angle), "dy": r * F.sin(angle)})


def unwrapped(ring: Column) -> Column:
    """A ring of (lon, lat) across the date line in one piece: the smaller side moves by 360 degrees."""
    jump = F.exists(F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), lambda a, b: F.abs(a["lon"] - b["lon"]) > 180), lambda j: j)
    east = F.size(F.filter(ring, lambda p: p["lon"] >= 0)) * 2 >= F.size(ring)
    move = lambda p: F.struct(F.when(east & (p["lon"] < 0), p["lon"] + 360).when(~east & (p["lon"] >= 0), p["lon"] - 360).otherwise(p["lon"]).alias("lon"), p["lat"].alias("lat"))
    return F.when(F.size(ring) < 2, ring).when(jump, F.transform(ring, move)).otherwise(F.transform(ring, lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))))


def shoelace(ring: Column) -> Column:
    """(area, lon, lat) of a closed ring: signed area and centroid."""
    pairs = F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b"), (a["lon"] * b["lat"] - b["lon"] * a["lat"]).alias("c")))
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    add = lambda t, p: F.struct((t["s"] + p["c"]).alias("s"), (t["x"] + (p["a"]["lon"] + p["b"]["lon"]) * p["c"]).alias("x"), (t["y"] + (p["a"]["lat"] + p["b"]["lat"]) * p["c"]).alias("y"))
    done = lambda t: F.struct((t["s"] / 2).alias("area"), F.when(t["s"] != 0, t["x"] / (3 * t["s"])).alias("lon"), F.when(t["s"] != 0, t["y"] / (3 * t["s"])).alias("lat"))
    return F.aggregate(pairs, zero, add, done)


def largest_ring(rings: Column) -> Column:
    """Centroid (area, lon, lat) of the ring of largest area."""
    return F.array_max(F.transform(rings, lambda r: F.struct(F.abs(shoelace(r)["area"]).alias("area"), shoelace(r)["lon"].alias("lon"), shoelace(r)["lat"].alias("lat"))))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    a = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return F.lit(2 * 6371.0) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
