"""Two tables that describe the same undertakings without a common key, matched with a confidence.

Both tables are sorted together by several composite keys: the place's words forwards and backwards, each also from the
last letter on, and one place word with a word of device or developer. Within a sliding window of each order the records of the
two sides are compared field by field with weights; those of equal keys always are. Records alike in all fields are one class and
compared once. Of the pairs that stand, records of one undertaking are grouped, and groups and projects are assigned one to one
so that the total confidence is largest.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from ..functions.countries import canonical_country
from ..session import cut_lineage, cut_packed, free_unused
from .assignment import best_assignment
from .components import components
from .lcs import lcs_ratio, lcs_ratios
from .project_names import REGION, RESOURCES, lead_of, owners, place_of, resource_fits, slug, telling, words

WINDOW = 12
THRESHOLD = 0.6
REACH = 6  # how far apart in a record's name place and owner may stand
# weights of the field similarities
PLACE, COUNTRY, TECHNOLOGY, OWNER = 0.55, 0.15, 0.1, 0.2
FIELDS = ("place", "owners", "others", "lead", "country", "kind")
# ``fields`` has all FIELDS as one JSON text: what is moved and kept of a profile
PROFILE = "side string, id string, place array<string>, owners array<string>, others array<string>, lead array<string>, country string, kind string, fields string"


def _counted(df: DataFrame) -> DataFrame:
    """Equal rows of a batch as one, with their number ``n``, so that a hot key moves few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            yield from pa.Table.from_batches([b]).group_by(names).aggregate([([], "count_all")]).select([*names, "count_all"]).rename_columns([*names, "n"]).to_batches()

    return df.mapInArrow(run, df.withColumn("n", F.lit(0).cast("bigint")).schema)


def _usual(df: DataFrame, id_col: str, fields: list[str], other: DataFrame | None = None) -> DataFrame:
    """Each record's most frequent value of every field, over all its rows; counts are summed before they are compared.

    With ``other`` (``id``, ``name``) also ``names``, every different ``name`` of a record's rows and of these. The rows are
    moved once, by record, and reduced there.
    """
    rows = df.select(F.col(id_col).alias("id"), *[F.col(f).cast("string") for f in fields], F.lit(None).cast("string").alias("_other"))
    if other is not None:
        # names of what no row describes tell nothing
        rows = rows.withColumn("_own", F.lit(True)).unionByName(other.select("id", F.col("name").alias("_other"), F.lit(False).alias("_own")), allowMissingColumns=True)
    else:
        rows = rows.withColumn("_own", F.lit(True))
    here = _counted(rows.where("id is not null")).repartition("id")
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in [*fields, "_other"]])).alias("c")
    counts = here.select("id", "_own", "n", cells).select("id", "_own", "n", "c.*").groupBy("id", "_own", "f", "v").agg(F.sum("n").alias("n"))
    best = [F.max_by("v", F.when((F.col("f") == f) & F.col("v").isNotNull(), F.struct("n", "v"))).alias(f) for f in fields]
    names = [F.collect_set(F.when(F.col("f").isin("name", "_other"), F.col("v"))).alias("names")] if other is not None else []
    return counts.groupBy("id").agg(*best, *names, F.max("_own").alias("_own")).where("_own").drop("_own")


def _orders(pairs: set[tuple[str, str]], owned: set[tuple[str, str]]) -> set[str]:
    keys = set()
    for a, b in pairs:
        keys |= {f"1{a} {b}", f"2{b} {a}", f"3{b[::-1]} {a[::-1]}", f"4{a[::-1]} {b[::-1]}"}
    return keys | {f"5{b} {a}" for a, b in owned}


def _keys(side: str, place: list[str], own: list[str], others: list[str], lead: list[str]) -> set[str]:
    """The sort keys of a profile, from its fields alone."""
    if side == "p":
        return _orders(set(zip(place, place[1:])), {(p, o) for p in place for o in (*own, *lead)})
    told = len(own) >= 2 or len(others) >= 2  # the place is whole elsewhere
    near = set() if told else {(place[i], place[j]) for i in range(len(place)) for j in range(max(0, i - REACH), min(len(place), i + REACH + 1)) if place[i] != place[j]}
    return _orders({x for words_ in (place, others, own) for x in zip(words_, words_[1:])}, near)


def _project_row(r: dict) -> tuple:
    place = place_of(r["name"], r["device"], r["developer"], r["primre_website"], r["location"])
    extra = [w for w in telling(r["name"]) if max((lcs_ratio(w, p) for p in place), default=0.0) < 0.7]
    return "p", r["id"], list(place), list(owners(r["device"], "")), extra, list(owners("", r["developer"])), canonical_country(r["country"]), r["technology"]


def _variant_rows(pdf: pd.DataFrame) -> list[tuple]:
    """A row for each different place and other words that the names (``name`` and ``names``) of a project tell.

    A variant without a place of its own, such as one of device or developer only, stands with the place of the main name.
    """
    out = []
    names = pdf["names"] if "names" in pdf else [None] * len(pdf)
    for r, others in zip(pdf.drop(columns="names", errors="ignore").fillna("").to_dict("records"), names):
        main = _project_row(r)
        seen = {(tuple(main[2]), tuple(main[4])): main}
        own = [*main[3], *main[5]]
        for name in sorted({*(others if others is not None else ())} - {r["name"]}):
            row = _project_row(r | {"name": name})
            if len(row[2]) < 2 or any(lcs_ratio(w, o) >= 0.8 for w in row[2] for o in own):
                extra = [w for w in telling(name) if max((lcs_ratio(w, p) for p in main[2]), default=0.0) < 0.7]
                row = (*main[:4], extra, *main[5:])
            seen.setdefault((tuple(row[2]), tuple(row[4])), row)
        out += seen.values()
    return out


def _record_rows(pdf: pd.DataFrame) -> list[tuple]:
    out = []
    for r in pdf.fillna("").to_dict("records"):
        named = telling(r["primre_name"])
        lands = set(words(r["country"]))
        aside = [w for part in r["location"].split(",") for w in (telling(part) if not set(words(part)) & REGION else []) if w not in lands]
        spots = list(slug(r["primre_website"]))
        out.append(("r", r["id"], named, spots, aside, lead_of(r["primre_name"]), canonical_country(r["country"]), r["primre_resource"]))
    return out


def confidence(project: tuple, record: tuple) -> float:
    """Weighted likeness of a project and a record; 0 where what both tell contradicts.

    Both are (place words, device words, other words, developer words, country, kind); of a record the place words are all
    telling words of its name and the developer words those that can only name one.
    """
    place, device, extra, developer, land, tech = project
    named, spots, aside, lead, other, resource = record
    if not place or (land and other and land != other):
        return 0.0
    fits = resource_fits(resource, tech)
    if fits is False:
        return 0.0
    pool = [*named, *spots, *aside]
    near = [max((lcs_ratio(p, w) for w in pool), default=0.0) for p in place]
    likeness = sum(near) / len(near)
    whole = len(place) >= 2 and min(near) >= 0.75 and likeness >= 0.82
    if not whole and len(place) >= 2:  # the words written as one
        whole = any(lcs_ratio("".join(place), w) >= 0.88 for w in pool if len(w) > 9)
    own = [*device, *developer, *extra]
    hit = [w for w in named if max((lcs_ratio(w, o) for o in own), default=0.0) >= 0.8]
    strange = [w for w in named if w not in hit and max((lcs_ratio(w, p) for p in [*place, "".join(place)]), default=0.0) < 0.7]
    if developer and [w for w in strange if w in lead] or device and [w for w in strange if w not in lead]:
        return 0.0
    if whole:
        score = PLACE * (likeness if min(near) > 0 else 0.9)
    elif max(near) >= 0.85 and hit and not strange and not [w for w in aside + spots if max(lcs_ratio(w, p) for p in place) < 0.7]:
        score = PLACE * 0.6 * max(near)
    else:
        return 0.0
    score += COUNTRY * (1.0 if land and land == other else 0.5)
    score += TECHNOLOGY * (1.0 if fits else 0.5)
    score += OWNER * (1.0 if hit else 0.6 if not strange else 0.0 if own else 0.5)
    return min(score, 1.0)


def _met(keys: np.ndarray, sides: np.ndarray, window: int, since: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places (project, record) of the keys of two sides, in order, that stand near one another and are alike.

    A key meets the last ``window`` keys of the other side among the ``4 * window`` before it. Only pairs whose later key is at
    ``since`` or after are given.
    """
    first: list[np.ndarray] = []
    second: list[np.ndarray] = []
    for side, other in (("p", "r"), ("r", "p")):
        at, theirs = np.flatnonzero(sides == side), np.flatnonzero(sides == other)
        at = at[at >= since]
        back = np.searchsorted(theirs, at)[:, None] - 1 - np.arange(window)
        there = theirs[np.maximum(back, 0)] if len(theirs) else np.zeros_like(back)
        near = (back >= 0) & (at[:, None] - there <= 4 * window) if len(theirs) else np.zeros(back.shape, bool)
        here = np.broadcast_to(at[:, None], back.shape)[near]
        (first if side == "p" else second).append(here)
        (second if side == "p" else first).append(there[near])
    p, r = np.concatenate(first), np.concatenate(second)
    size = np.char.str_len(keys) if len(keys) else np.zeros(0, int)
    fits = (keys[p].astype("U1") == keys[r].astype("U1")) & (2 * np.minimum(size[p], size[r]) >= 0.7 * (size[p] + size[r])) & (keys[p] != keys[r])
    p, r = p[fits], r[fits]
    alike = lcs_ratios(keys[p], keys[r]) >= 0.7
    return p[alike], r[alike]


def _neighbours(keys: DataFrame, window: int) -> DataFrame:
    """Pairs (``project_id``, ``primre_row_id``) met within the sliding window of the global order of ``key`` (``key``, ``side``, ``id``).

    The window counts distinct keys of a side, however many rows have them. Keys are range-partitioned; where a partition begins, its
    first keys are windowed once more after the keys before it, from as many partitions as these lie in, so the result
    does not depend on how the order is cut. All rows of equal or neighbouring keys meet, by joins on the keys' hashes, which Spark
    splits where a key is hot; a hash that two keys share can only add a pair to compare. ``land`` (optional): pairs whose lands
    are not null and differ are left out.
    """
    told = ["land"] if "land" in keys.columns else []
    of = lambda s, key, one: keys.where(F.col("side") == s).select(F.xxhash64("key").alias(key), F.col("id").alias(one), *[F.col(c).alias(f"{c}_{s}") for c in told])
    ordered = keys.select("key", "side").repartitionByRange("key").distinct().sortWithinPartitions("key", "side").withColumn("part", F.spark_partition_id())
    reach = 4 * window
    schema = "p string, r string, part int, n bigint, place bigint, key string, side string"
    columns = [c.split(" ")[0] for c in schema.split(", ")]
    filled = lambda many, **cols: pd.DataFrame({c: list(cols.get(c, [None] * many)) for c in columns}, columns=columns, dtype=object)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, tail, n, part = [], pd.DataFrame({"key": [], "side": []}), 0, None
        for pdf in frames:
            if len(pdf) == 0:
                continue
            part = int(pdf["part"].iloc[0])
            now = pd.concat([tail, pdf[["key", "side"]]], ignore_index=True)
            names, sides = now["key"].to_numpy(str), now["side"].to_numpy(str)
            p, r = _met(names, sides, window, len(tail))
            same = np.flatnonzero(names[1:] == names[:-1])  # equal keys, which lie in one partition, meet without the window
            same = same[same + 1 >= len(tail)]
            p, r = np.concatenate([p, same]), np.concatenate([r, same])
            yield filled(len(p), p=names[p].tolist(), r=names[r].tolist())
            if n < reach:
                head += [(part, n + i, k, s) for i, (k, s) in enumerate(zip(pdf["key"].iloc[: reach - n], pdf["side"]))]
            n += len(pdf)
            tail = now.iloc[-reach:]
        if part is not None:
            ends = {place: (part, place, k, s) for part, place, k, s in head} | {n - len(tail) + i: (part, n - len(tail) + i, k, s) for i, (k, s) in enumerate(zip(tail["key"], tail["side"]))}
            yield filled(len(ends), n=[n] * len(ends), **dict(zip(("part", "place", "key", "side"), zip(*ends.values()))))

    hashed = [F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(c) for c in "pr"]
    once = cut_packed(ordered.mapInPandas(run, schema).select(*hashed, *columns[2:]))
    free_unused(keys.sparkSession)
    # which partitions' first keys the last keys of a partition go before; a row a partition comes to the driver
    counts = [(r["part"], r["n"]) for r in once.where("part is not null").groupBy("part").agg(F.max("n").alias("n")).orderBy("part").collect()]
    follow = []
    for i, (part, n) in enumerate(counts):
        between = 0
        for later, m in counts[i + 1 :]:
            if between >= reach:
                break
            follow.append((part, later, n - (reach - between)))  # from this place on
            between += m
    spark = keys.sparkSession
    ends = once.where("part is not null").select("part", "place", "key", "side")
    sent = ends.join(F.broadcast(spark.createDataFrame(follow, "part int, later int, since bigint")), "part").where("place >= since")
    sent = sent.select(F.col("later").alias("seam"), "part", "place", "key", "side").unionByName(ends.where(F.col("place") < reach).select(F.col("part").alias("seam"), "part", "place", "key", "side"))

    def seams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = pd.concat([f for f in frames if len(f)] or [pd.DataFrame(columns=["seam", "part", "place", "key", "side"])], ignore_index=True)
        for seam, rows in rest.groupby("seam"):
            rows = rows.sort_values(["part", "place"])
            names, sides = rows["key"].to_numpy(str), rows["side"].to_numpy(str)
            p, r = _met(names, sides, window, int((rows["part"] < seam).sum()))
            yield pd.DataFrame({"p": names[p].tolist(), "r": names[r].tolist()}, dtype=object)

    met = once.where("part is null").select("p", "r").unionByName(sent.repartition("seam").mapInPandas(seams, "p string, r string").select(*hashed))
    near = met.join(of("r", "r", "primre_row_id"), "r").drop("r").join(of("p", "p", "project_id"), "p")
    if told:
        near = near.where("land_p is null or land_r is null or land_p = land_r")
    return near.select("project_id", "primre_row_id").distinct()


def _compared(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """``pairs`` whose records stand together: ``project_id`` and ``record`` (``first`` of the ``profiles``), ``confidence``."""
    side = lambda s, key: profiles.where(F.col("side") == s).select(F.col("id").alias(key), F.col("fields").alias(s), F.col("first").alias(f"first_{s}"))
    both = pairs.join(side("p", "project_id"), "project_id").join(side("r", "primre_row_id"), "primre_row_id").select("p", "r", "first_p", "first_r")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            p, r = ({t: json.loads(t) for t in pdf[s].unique()} for s in "pr")
            yield pd.DataFrame({"project_id": pdf["first_p"], "record": pdf["first_r"], "confidence": [confidence(p[x], r[y]) for x, y in zip(pdf["p"], pdf["r"])]})

    return both.mapInPandas(run, "project_id string, record string, confidence double").where(F.col("confidence") >= THRESHOLD)


def assign(edges: DataFrame, records: DataFrame) -> DataFrame:
    """Of ``edges`` (``project_id``, ``record``, ``confidence``) those of a one-to-one assignment of largest total confidence.

    ``records`` (``record``, ``country``, ``kind``, ``n`` copies). Records with the same best project are one undertaking and stay
    together, but for those whose country or resource contradicts that of the surest among them. A group and a project that no other
    group wants are settled at once; the rest is solved by connected component. Within one, a project keeps at most as many
    groups as the component has projects: more can never win, so a component of one crowded project stays small.
    """
    rank = lambda *o: F.row_number().over(Window.partitionBy("record").orderBy(*o))
    best = edges.withColumn("_i", rank(F.desc("confidence"), "project_id")).where("_i = 1").drop("_i").join(records, "record")
    lead = best.groupBy("project_id").agg(F.min_by(F.struct("record", "country", "kind"), F.struct((-F.col("confidence")).alias("c"), "record")).alias("lead"))
    told = lambda k: F.filter(F.transform(F.split(F.lower(k), ","), F.trim), lambda x: x.isin(*RESOURCES))
    apart = lambda a, b, none: (a != none) & (b != none) & (a != b)
    other = apart(F.col("country"), F.col("lead.country"), "") | ((F.size(told(F.col("kind"))) > 0) & (F.size(told(F.col("lead.kind"))) > 0) & ~F.arrays_overlap(told(F.col("kind")), told(F.col("lead.kind"))))
    grouped = best.join(lead, "project_id").select("record", F.when(other, F.col("record")).otherwise(F.col("lead.record")).alias("grp"), "n")
    wants = cut_lineage(edges.join(grouped, "record").groupBy("grp", "project_id").agg(F.sum(F.col("confidence") * F.col("n")).alias("w")))
    n = wants.groupBy("project_id").agg(F.count("*").alias("_n"))
    ranked = wants.join(n, "project_id").withColumn("_i", F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("w"), "project_id")))
    sure = ranked.where("_i = 1 and _n = 1").select("grp", "project_id")
    open_ = cut_lineage(wants.join(sure.select("grp"), "grp", "left_anti"))
    if open_.isEmpty():
        settled = sure
    else:
        node = lambda c: F.concat(F.lit(c[0] + ":"), F.col(c))
        links = open_.select(node("grp").alias("a"), node("project_id").alias("b"))
        parts = components(links.select(F.col("a").alias("id")).union(links.select("b")), links)
        held = open_.withColumn("id", node("project_id")).join(parts, "id").drop("id")
        size = held.groupBy("component").agg(F.count_distinct("project_id").alias("_m"))
        top = F.row_number().over(Window.partitionBy("project_id").orderBy(F.desc("w"), "grp"))
        held = held.join(size, "component").withColumn("_k", top).where("_k <= _m").select("component", "grp", "project_id", "w")

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            edges: dict[str, dict[str, float]] = {}
            for g, p, w in zip(pdf["grp"], pdf["project_id"], pdf["w"]):
                edges.setdefault(g, {})[p] = w
            return pd.DataFrame(list(best_assignment(edges).items()), columns=["grp", "project_id"])

        settled = sure.unionByName(held.groupBy("component").applyInPandas(solve, "grp string, project_id string"))
    return edges.join(grouped.join(settled, "grp").select("record", "project_id"), ["record", "project_id"]).select("project_id", "record", "confidence")


def match(projects: DataFrame, records: DataFrame, window: int = WINDOW, other_names: DataFrame | None = None) -> DataFrame:
    """``project_id``, ``primre_row_id``, ``confidence`` of the matched pairs; a record goes to one project at most, a project has the records of one undertaking.

    ``projects``: ``project_id``, ``name``, ``device``, ``developer``, ``country``, ``technology``, ``primre_website``,
    ``location``, rows of one project together count as one. ``records``: ``primre_row_id``, ``primre_name``, ``country``,
    ``primre_resource``, ``primre_website``, ``location``. Null is missing. A stated country or technology that differs, or
    a place that is only half the same without a common owner, parts two records. Ties go to the smaller project id.
    ``other_names``: ``project_id``, ``name``, further names of projects. Every different name of a project, its own and
    these, is tried; the best confidence stands.
    """
    fields = ["name", "device", "developer", "country", "technology", "primre_website", "location"]
    other = projects.select(F.lit(None).cast("string").alias("id"), "name").limit(0) if other_names is None else other_names.select(F.col("project_id").alias("id"), "name")
    p = _usual(projects, "project_id", fields, other)
    r = _usual(records, "primre_row_id", ["primre_name", "country", "primre_resource", "primre_website", "location"])

    def rows(make) -> object:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                made = [(*x, json.dumps(x[2:], ensure_ascii=False, separators=(",", ":"))) for x in make(pdf)]
                yield pd.DataFrame(made, columns=[c.split(" ")[0] for c in PROFILE.split(", ")])

        return run

    def exploded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = [(k, side, one, land) for side, one, text, land in zip(pdf["side"], pdf["id"], pdf["fields"], pdf["land"]) for k in _keys(side, *json.loads(text)[:4])]
            yield pd.DataFrame(out, columns=["key", "side", "id", "land"]).astype({"id": "int64", "land": "Int32"})

    mine = p.mapInPandas(rows(_variant_rows), PROFILE)
    cls = F.concat(F.lit("r"), F.hex(F.xxhash64(*FIELDS)), F.hex(F.xxhash64(F.lit(1), *FIELDS)))  # one for all records alike in all fields
    theirs = cut_packed(r.mapInPandas(rows(_record_rows), PROFILE).select("id", cls.alias("record"), "country", "kind", "fields"))
    # one row a class; of projects alike in all fields the smallest id stands for all
    once = lambda df, side, first: df.groupBy("fields", "country").agg(F.min(first).alias("first")).select(F.lit(side).alias("side"), "fields", F.when(F.col("country") != "", F.hash("country")).alias("land"), "first")
    both = cut_packed(once(mine, "p", "id").unionByName(once(theirs, "r", "record")).withColumn("id", F.monotonically_increasing_id()))
    free_unused(projects.sparkSession)
    keys = both.select("side", "id", "fields", "land").mapInPandas(exploded, "key string, side string, id bigint, land int")
    edges = cut_lineage(_compared(_neighbours(keys, window), both).groupBy("project_id", "record").agg(F.max("confidence").alias("confidence")))
    free_unused(projects.sparkSession)
    records = theirs.groupBy("record", "country", "kind").agg(F.count_distinct("id").alias("n"))
    members = theirs.select("record", F.col("id").alias("primre_row_id")).distinct()
    return assign(edges, records).join(members, "record").select("project_id", "primre_row_id", "confidence")
