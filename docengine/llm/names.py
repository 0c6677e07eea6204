"""Records that name the same facility, linked across typing variants.

Names are parsed into place words, initials and kind. Place words meet by suffix blocking: each word is indexed under its last
letters, also with one letter left out, so that one slip does not part two spellings. A suffix shared by too many names is
first refined (more letters, and the initial of the place's other word) and dropped only where the refined key stands in for
it. Names in one block are compared by the ratio of their longest common subsequence. Links make places; within a place the
kind of facility parts what stands side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window

from ..functions.countries import canonical_country
from ..session import cut_lineage
from .components import components
from .facility_names import folded, parse
from .lcs import lcs_ratio, lcs_ratios
from .vocabulary import Vocabulary

COMMON = 60
CROWD = 256  # names of one block that one task compares with one another
FULL, PART = 0.8, 0.8
FORM = "form string, shape string, one string, two string, lead string, kinds string"
_SEP = "\x1f"


def _form(name: str, main: bool, vocabulary: Vocabulary) -> tuple[str, str, str, str, str] | None:
    """Shape, words, the initial known besides them, and kinds of a name; None if it names no place firmly."""
    p = parse(name, vocabulary)
    if p is None:
        return None
    kinds = "|".join(sorted(p["kinds"]))
    t = p["tokens"]
    if len(t) >= 2:
        return "full", t[0], "".join(t[1:]), "", kinds
    if p["initials"]:
        letter, place = p["initials"][0]
        return "part", t[0], "", letter + ("<" if place == 0 else ">"), kinds
    if p["acronym"]:
        return "part", t[0], "", p["acronym"][0] + "<", kinds
    # two words written as one show it by a capital inside or by their length; a by-name of one word names no place firmly
    glued = any(a.islower() and b.isupper() for a, b in zip(name, name[1:]))
    return ("joined", t[0], "", "", kinds) if len(t[0]) >= (10 if glued else 11 if main else 16) else None


def parse_names(names: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``names`` (``id``, ``country``, ``name``, ``is_main``) with the parts of each name; names without a place are left out."""
    schema = "id string, country string, is_main boolean, " + FORM

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for i, country, name, main in zip(pdf["id"], pdf["country"], pdf["name"], pdf["is_main"]):
                if (f := _form(name or "", main, vocabulary)) is not None:
                    land = canonical_country(country)
                    # the same initials in two countries or of two kinds are two names
                    rows.append((i, land, main, _SEP.join([*f[:4], land, f[4]] if f[0] == "part" else f[:4]), *f))
            yield pd.DataFrame(rows, columns=["id", "country", "is_main", "form", "shape", "one", "two", "lead", "kinds"])

    return names.mapInPandas(run, schema)


def _suffixes(word: str, size: int) -> set[str]:
    """The last ``size`` letters, also with one of the last ``size + 1`` left out."""
    tail = word[-(size + 1) :]
    return {word[-size:]} | {tail[:i] + tail[i + 1 :] for i in range(len(tail))} if len(word) >= size else {word}


def block_keys(shape: str, one: str, two: str, lead: str, size: int, refined: bool) -> set[str]:
    """The keys under which a name is indexed; refined ones hold the initial of the place's other word."""
    pairs = [(one, two[:1]), (two, one[:1])] if shape == "full" else [(one, lead[:1] if shape == "part" else one[:1])]
    return {f"{size}{s}{'.' + other if refined else ''}" for word, other in pairs for s in _suffixes(word, size)}


def place_score(a: tuple[str, str, str, str], b: tuple[str, str, str, str]) -> float:
    """How alike two names' places are; 0 where initials contradict."""
    if a[0] == "part" and b[0] != "part":
        a, b = b, a
    if b[0] != "part":
        x, y = a[1] + a[2], b[1] + b[2]
        best = lcs_ratio(x, y)
        if best < 0.95 and b[2]:
            best = max(best, lcs_ratio(x, b[2] + b[1]))
        if best < 0.95 and a[2] and not b[2]:
            best = max(best, lcs_ratio(a[2] + a[1], y))
        return best
    token, lead = b[1], b[3]
    first = lead[-1] == "<"
    if a[0] == "part":
        if a[3][-1] != lead[-1] or a[3][0] != lead[0]:
            return 0.0
        return lcs_ratio(a[1], token)
    if a[0] == "joined":
        whole = a[1]
        if first:
            return lcs_ratio(whole[-len(token) :], token) if whole[0] == lead[0] else 0.0
        return lcs_ratio(whole[: len(token)], token)
    best = 0.0
    for other, word in ((a[1], a[2]), (a[2], a[1])):
        if other[:1] == lead[0] and (len(lead) < 3 or word[:1] == lead[1]):
            best = max(best, lcs_ratio(word, token) - (0.02 if (word == a[2]) != first else 0))
    return best


def _scores(a: list[tuple], b: list[tuple]) -> np.ndarray:
    """``place_score`` of pairs of names; those of whole words all together."""
    out = np.zeros(len(a))
    whole = np.flatnonzero([x[0] != "part" and y[0] != "part" for x, y in zip(a, b)])
    for i in set(range(len(a))) - set(whole.tolist()):
        out[i] = place_score(a[i], b[i])
    text = lambda rows, turned: np.array([rows[i][2] + rows[i][1] if turned else rows[i][1] + rows[i][2] for i in whole], dtype=str)
    straight = lcs_ratios(text(a, False), text(b, False))
    two_a, two_b = (np.array([rows[i][2] != "" for i in whole], bool) for rows in (a, b))
    for turn_a, turn_b, use in ((False, True, two_b), (True, False, two_a & ~two_b)):
        use = use & (straight < 0.95)
        if use.any():
            straight[use] = np.maximum(straight[use], lcs_ratios(text(a, turn_a)[use], text(b, turn_b)[use]))
    out[whole] = straight
    return out


def _compare(blocks: DataFrame) -> DataFrame:
    """Links between all names of each block (``key``, ``half``): those of one half with those of the other, or all where there is one."""

    def pairs(group: list[tuple]) -> tuple[list[tuple], list[tuple]]:
        left, right = [g for g in group if g[0] == 0], [g for g in group if g[0] == 1]
        if right:
            return [x for x in left for _ in right], [y for _ in left for y in right]
        return [x for i, x in enumerate(left) for _ in left[:i]], [y for i in range(len(left)) for y in left[:i]]

    def links(a: list[tuple], b: list[tuple]) -> pd.DataFrame:
        score = _scores([x[2:6] for x in a], [y[2:6] for y in b])
        weak = np.array([x[2] == "part" or y[2] == "part" for x, y in zip(a, b)], bool)
        keep = np.flatnonzero(score >= np.where(weak, PART, FULL))
        return pd.DataFrame({"form_a": [max(a[i][1], b[i][1]) for i in keep], "form_b": [min(a[i][1], b[i][1]) for i in keep], "score": score[keep], "weak": weak[keep]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, group, a, b = None, [], [], []
        for pdf in frames:
            for k, *rest in zip(pdf["key"], pdf["half"], pdf["form"], pdf["shape"], pdf["one"], pdf["two"], pdf["lead"]):
                if k != key:
                    x, y = pairs(group)
                    a, b, key, group = a + x, b + y, k, []
                    if len(a) > 50_000:
                        yield links(a, b)
                        a, b = [], []
                group.append(tuple(rest))
        x, y = pairs(group)
        yield links(a + x, b + y)

    return blocks.repartition("key").sortWithinPartitions("key", "half", "form").select("key", "half", "form", "shape", "one", "two", "lead").mapInPandas(run, "form_a string, form_b string, score double, weak boolean")


def _blocks(forms: DataFrame, common: int = COMMON, crowd: int = CROWD) -> DataFrame:
    """Names by block key: short suffixes where few names share one, longer refined ones for the rest, the longest without bound.

    A block of the longest suffix with more than ``crowd`` names is cut into pieces, and each two pieces are a block (``half`` 0 and 1), so no task
    holds it whole and no two of its names go uncompared.
    """
    schema = "level int, key string, " + FORM

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            keys = [[(level, k) for level, (size, refined) in enumerate(((5, False), (7, True), (9, True))) for k in sorted(block_keys(*r, size, refined))] for r in zip(pdf["shape"], pdf["one"], pdf["two"], pdf["lead"])]
            at = np.repeat(np.arange(len(pdf)), [len(k) for k in keys])
            out = pdf.iloc[at].copy()
            out.insert(0, "key", [x for k in keys for _, x in k])
            out.insert(0, "level", np.array([x for k in keys for x, _ in k], np.int32))
            yield out

    keyed = cut_lineage(forms.mapInPandas(run, schema))
    shared = keyed.groupBy("level", "key").agg(F.count("*").alias("n")).where("n > 1")
    rows = keyed.join(shared, ["level", "key"])
    # a name whose suffix too many share goes on to the next level, with all its keys
    on = lambda level, most: F.coalesce(F.bool_or((F.col("level") == level) & (F.col("n") > most)), F.lit(False))
    flags = rows.groupBy("form").agg(on(0, common).alias("second"), on(1, 4 * common).alias("third"))
    rows = rows.join(flags, "form").where(((F.col("level") == 0) & (F.col("n") <= common)) | (F.col("second") & (F.col("level") == 1) & (F.col("n") <= 4 * common)) | (F.col("second") & F.col("third") & (F.col("level") == 2)))
    pieces = F.ceil(F.col("n") / crowd).cast("int")
    mine = F.pmod(F.xxhash64("form"), pieces).cast("int")
    others = F.transform(F.sequence(F.lit(0), pieces - 1), lambda j: F.struct(F.concat_ws(":", "key", F.least(j, mine).cast("string"), F.greatest(j, mine).cast("string")).alias("key"), (mine > j).cast("int").alias("half")))
    apart = F.when((F.col("level") < 2) | (F.col("n") <= crowd), F.array(F.struct(F.col("key").alias("key"), F.lit(0).alias("half")))).otherwise(others)
    names = [c.split(" ")[0] for c in FORM.split(", ")]
    return rows.select(*names, F.explode(apart).alias("k")).select("k.key", "k.half", *names)


def learned(names: DataFrame, share: float = 0.02, least: int = 5) -> Vocabulary:
    """A vocabulary for a register of which none is known: words that ``share`` of the different names hold, ``least`` at least, are fillers.

    A name has few words, so there are at most its usual number of words over ``share`` such words.
    """
    fold = F.array_distinct(F.regexp_extract_all(F.lower("name"), F.lit(r"(?U)[^\W\d_][\w'’.]*"), F.lit(0)))
    different = names.where("name is not null").select("name").distinct()
    counts = different.select(F.explode(fold).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    n = different.count()
    return Vocabulary(fillers=frozenset(folded(r["word"]).rstrip(".'") for r in counts.where(F.col("n") >= max(least, share * n)).select("word").collect()))


def link_names(names: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``id`` and ``entity`` of every record whose name names a facility: equal entities mean the same one.

    ``names``: ``id`` of the record, its ``country``, each ``name`` it goes by, and whether that is its main one. Country
    names in other forms count as one; two stated countries that differ forbid a link through initials only. A record
    without a parsable name is left out; one without a kind goes with the place's most recorded facility. Null and empty
    names name nothing; repeated rows change nothing. Without a ``vocabulary`` frequent words are learned as fillers (``learned``)
    and no kinds are told.
    """
    vocabulary = vocabulary or learned(names)
    parsed = cut_lineage(parse_names(names.where("id is not null and name is not null"), vocabulary))
    forms = parsed.select("form", "shape", "one", "two", "lead", F.lit("").alias("kinds")).distinct()
    per_form = parsed.groupBy("form").agg(F.min("id").alias("rep"), F.max("country").alias("c1"), F.min(F.when(F.col("country") != "", F.col("country"))).alias("c0"), F.array_distinct(F.flatten(F.collect_set(F.split("kinds", r"\|")))).alias("k"))
    links = cut_lineage(_compare(_blocks(cut_lineage(forms))).groupBy("form_a", "form_b").agg(F.max("score").alias("score"), F.max("weak").alias("weak")))
    a, b = (per_form.select(*[F.col(c).alias(f"{c}_{s}") for c in ("form", "rep", "c0", "c1", "k")]) for s in "ab")
    known = links.join(a, "form_a").join(b, "form_b")
    apart = F.col("c0_a").isNotNull() & F.col("c0_b").isNotNull() & (F.col("c0_a") > F.col("c1_b")) | (F.col("c1_a") != "") & F.col("c0_b").isNotNull() & (F.col("c1_a") < F.col("c0_b"))
    told = lambda k: F.size(F.array_remove(k, "")) > 0
    unlike = told(F.col("k_a")) & told(F.col("k_b")) & ~F.arrays_overlap("k_a", "k_b")
    known = known.where(~(apart & (F.col("weak") | (F.col("score") < 0.88))) & ~(unlike & F.col("weak")))
    known = cut_lineage(known)
    # a name without a country has that of its spellings, so that initials of another country do not join it
    solid = known.where("not weak")
    beside = solid.select(F.col("form_a").alias("form"), F.col("c0_b").alias("land")).union(solid.select("form_b", "c0_a")).where("land is not null").groupBy("form").agg(F.min("land").alias("land"))
    for s in "ab":
        known = known.join(beside.select(F.col("form").alias(f"form_{s}"), F.col("land").alias(f"land_{s}")), f"form_{s}", "left")
    land = lambda s: F.coalesce(f"c0_{s}", f"land_{s}")
    known = cut_lineage(known.where(~(F.col("weak") & F.coalesce(land("a") != land("b"), F.lit(False)))).drop("land_a", "land_b"))
    # a name of initials goes to its one best whole name, and to other initials only of the same stated country
    part = lambda s: F.col(f"form_{s}").like("part%")
    whole = known.where("weak").where(part("a") != part("b")).withColumn("_w", F.when(part("a"), F.col("form_a")).otherwise(F.col("form_b")))
    whole = whole.withColumn("_r", F.row_number().over(Window.partitionBy("_w").orderBy(F.desc("score"), (F.col("c0_a") == F.col("c0_b")).desc_nulls_last(), "rep_a", "rep_b"))).where("_r = 1")
    alike = known.where("weak").where(part("a") & part("b") & (F.col("score") >= 0.85))
    # where a country is blank, initials alone link only names that have no whole one
    placed = whole.select(F.col("_w").alias("form"))
    loose = alike.where(F.col("c0_a").isNull() | F.col("c0_b").isNull())
    for side in ("form_a", "form_b"):
        loose = loose.join(placed.withColumnRenamed("form", side), side, "left_anti")
    alike = alike.where(F.col("c0_a") == F.col("c0_b"))
    edges = known.where("not weak").select("rep_a", "rep_b").union(whole.select("rep_a", "rep_b")).union(alike.select("rep_a", "rep_b")).union(loose.select("rep_a", "rep_b"))
    same = parsed.join(per_form.select("form", "rep"), "form").select(F.col("id").alias("rep_a"), F.col("rep").alias("rep_b")).where("rep_a <> rep_b")
    links = edges.union(same).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    places = components(parsed.select("id"), links)
    kinds = parsed.groupBy("id").agg(F.collect_list(F.struct("is_main", "kinds")).alias("n")).select("id", kind_of("n", vocabulary.kinds).alias("kinds"))
    return by_kind(places.join(kinds, "id"))


def kind_of(names: Column, kinds: tuple[str, ...]) -> Column:
    """The kinds a record may be of: those all its names allow, its main name's first; empty if none is told."""
    main = F.filter(names, lambda n: n["is_main"] & (n["kinds"] != ""))
    told = F.filter(names, lambda n: n["kinds"] != "")
    use = F.when(F.size(main) > 0, main).otherwise(told)
    every = F.array(*[F.lit(k) for k in kinds]).cast("array<string>")
    both = F.aggregate(told, every, lambda acc, n: F.array_intersect(acc, F.split(n["kinds"], r"\|")))
    first = F.aggregate(use, every, lambda acc, n: F.array_intersect(acc, F.split(n["kinds"], r"\|")))
    alone = F.split(F.get(use, F.lit(0))["kinds"], r"\|")
    return F.when(F.size(told) == 0, F.array().cast("array<string>")).when(F.size(both) > 0, both).when(F.size(first) > 0, first).otherwise(alone)


def by_kind(records: DataFrame) -> DataFrame:
    """Facilities within places: ``records`` has ``id``, ``component``, ``kinds``."""
    sure = records.where("size(kinds) = 1").groupBy("component", F.col("kinds")[0].alias("kind")).agg(F.count("*").alias("n"))
    found = sure.groupBy("component").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "kind"))).alias("found"))
    joined = records.join(found, "component", "left")
    open_ = F.size("kinds") == 0
    fit = F.get(F.filter(F.coalesce("found", F.array().cast("array<struct<n:bigint,kind:string>>")), lambda x: open_ | F.array_contains("kinds", x["kind"])), F.lit(0))["kind"]
    return joined.select("id", F.concat_ws("#", "component", F.coalesce(fit, F.array_join(F.array_sort("kinds"), "|"))).alias("entity"))


def groups(linked: DataFrame) -> DataFrame:
    """One row a record: ``id``, ``entity``, its ``representative`` (the smallest key) and ``n_records`` of the entity."""
    g = linked.groupBy("entity").agg(F.min("id").alias("representative"), F.count("*").alias("n_records"))
    return linked.join(g, "entity").select("id", "entity", "representative", "n_records")


def pairs(linked: DataFrame) -> DataFrame:
    """All pairs of records of one entity, the smaller key first."""
    a, b = linked.select(F.col("id").alias("key_a"), "entity"), linked.select(F.col("id").alias("key_b"), "entity")
    return a.join(b, "entity").where("key_a < key_b").select("key_a", "key_b")
