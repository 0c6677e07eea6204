"""Attributes told in text: capacities, labels, years, names, places, coordinates, depths. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T, vocab
from ..functions.rx import find_all, let, uni


def capacities(text: Column) -> Column:
    """Figures of power as written, number and unit with one blank between; figures of energy are none."""
    numbers, units = find_all(text, uni(vocab.CAPACITY), 1), find_all(text, uni(vocab.CAPACITY), 2)
    return F.zip_with(numbers, units, lambda n, u: F.concat(F.replace(n, F.lit(" "), F.lit("")), F.lit(" "), u))


def labels(text: Column, table: tuple[tuple[str, str], ...]) -> Column:
    """Labels whose pattern occurs, in the table's order."""
    return F.array_compact(F.array(*[F.when(text.rlike(uni(p, True)), F.lit(n)) for n, p in table]))


def years(text: Column) -> Column:
    return F.array_sort(F.array_distinct(find_all(text, uni(vocab.YEAR), 1)))


def has(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    return F.coalesce(text.rlike(uni(pattern, ignore_case)), F.lit(False))


def signal_score(text: Column, has_site: Column) -> Column:
    """How many of capacity, verb of deployment, device and test site are told (0 to 4)."""
    parts = [has(text, vocab.CAPACITY, False), has(text, vocab.DEPLOY_VERB), has(text, vocab.DEVICE_WORD), F.coalesce(has_site, F.lit(False))]
    return sum((p.cast("int") for p in parts[1:]), parts[0].cast("int"))


def _list(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def first_by_lower(values: Column, most: int | None = None) -> Column:
    """Distinct values, case apart, in the order they were first seen."""
    both = F.transform(values, lambda v: F.struct(F.lower(v).alias("k"), v.alias("v")))
    kept = F.aggregate(both, F.slice(both, 1, 0), lambda acc, x: F.when(F.exists(acc, lambda y: y["k"] == x["k"]), acc).otherwise(F.concat(acc, F.array(x))))
    out = F.transform(kept, lambda x: x["v"])
    return out if most is None else F.slice(out, 1, most)


def named_entities(text: Column, most: int = 12) -> Column:
    """Capitalised phrases without leading filler words; no countries, years or fillers; at most ``most``."""
    stop, lands = _list(vocab.NOT_NAMES), _list(vocab.COUNTRIES)

    def lead(n: Column) -> Column:
        words = F.split(F.regexp_replace(n, "^[ .-]+|[ .-]+$", ""), uni(r"\s+"))
        kept = F.aggregate(words, F.array().cast("array<string>"), lambda acc, w: F.when((F.size(acc) == 0) & F.array_contains(stop, F.lower(w)), acc).otherwise(F.concat(acc, F.array(w))))
        return F.array_join(kept, " ")

    found = F.transform(find_all(text, uni(vocab.NAME)), lead)
    fit = F.filter(found, lambda n: (F.length(n) >= 2) & ~F.array_contains(stop, F.lower(n)) & ~F.array_contains(lands, F.lower(n)) & ~n.rlike(rf"^(?:{vocab.YEAR})$"))
    return first_by_lower(fit, most)


def is_plausible_name(name: Column, common: Column | None = None) -> Column:
    """Whether a phrase can be a project's name: three letters, no figure, no single filler or ordinary word.

    ``common``: array of ordinary words in lower case, if a list is at hand.
    """
    s = T.strip(F.coalesce(name, F.lit("")))
    low = F.lower(s)
    single = F.size(F.split(s, uni(r"\s+"))) == 1
    filler = F.array_contains(_list(vocab.NOT_NAMES), low) | F.array_contains(_list(vocab.COUNTRIES), low)
    ordinary = F.lit(False)
    if common is not None:
        ordinary = (F.array_contains(common, low) | (low.endswith("s") & F.array_contains(common, F.regexp_replace(low, "s$", "")))) & ~s.rlike(r"[A-Z].*[A-Z]|\d")
    fits = (F.length(F.regexp_replace(s, "[^A-Za-z]", "")) >= 3) & ~s.rlike(uni(rf"^(?:{vocab.CAPACITY})$")) & ~s.rlike("^[kMG]W$")
    return fits & ~(single & (filler | ordinary))


def name_guess(title: Column, entities: Column, common: Column | None = None) -> Column:
    """The first plausible name of title and entities, blank if none."""
    return F.coalesce(F.get(F.filter(F.concat(F.array(title), entities), lambda n: is_plausible_name(n, common)), F.lit(0)), F.lit(""))


def undominated(values: Column) -> Column:
    """Values that are no part of a longer one."""
    return F.filter(values, lambda p: ~F.exists(values, lambda q: (q != p) & F.contains(q, p)))


def places(text: Column, known: Column | None = None) -> Column:
    """Place phrases after a preposition, as written, first seen first, without those contained in a longer one.

    ``known``: array of further place names.
    """
    preps, phrases = find_all(text, uni(vocab.LOCATION), 1), find_all(text, uni(vocab.LOCATION), 2)
    lands, mentions, stop = _list(vocab.COUNTRIES), _list(vocab.COUNTRY_MENTIONS), _list(vocab.NOT_NAMES)
    spots = _list(vocab.REGIONS) if known is None else F.array_union(_list(vocab.REGIONS), known)
    geo = uni(rf"\b({vocab.GEO_WORDS})\b")

    def fits(x: Column) -> Column:
        p, prep = x["p"], F.lower(x["w"])
        parts = F.transform(F.split(p, ","), T.strip)
        words = F.split(p, uni(r"\s+"))
        land = lambda q: F.array_contains(lands, F.lower(q)) | F.array_contains(mentions, q)
        no = F.forall(parts, land) | ((F.size(words) == 1) & p.rlike(uni(rf"^({vocab.GEO_WORDS})$"))) | F.array_contains(stop, F.lower(words[0])) | (p == "") | p.rlike(uni(vocab.YEAR)) | p.rlike(uni(vocab.NOT_PLACE)) | F.array_contains(lands, F.lower(p))
        yes = p.rlike(geo) | F.exists(parts, lambda q: F.array_contains(spots, q) | F.array_contains(lands, F.lower(q))) | (prep.isin("off", "near", "along") & (F.size(words) <= 4))
        return ~no & yes

    cut = lambda p: F.regexp_replace(F.split(p, uni(r"\.\s"))[0], "^[ ,.]+|[ ,.]+$", "")
    both = F.zip_with(preps, phrases, lambda w, p: F.struct(w.alias("w"), cut(p).alias("p")))
    return let(F.array_distinct(F.transform(F.filter(both, fits), lambda x: x["p"])), undominated)


def place_parts(text: Column) -> Column:
    """The comma-parted pieces of what follows a preposition of place: those that ``known`` of ``places`` is asked for."""
    cut = lambda p: F.regexp_replace(F.split(p, uni(r"\.\s"))[0], "^[ ,.]+|[ ,.]+$", "")
    return F.array_distinct(F.flatten(F.transform(find_all(text, uni(vocab.LOCATION), 2), lambda p: F.transform(F.split(cut(p), ","), T.strip))))


def known_places(entries: DataFrame, registered: DataFrame, keys: list[str], text: str = "text", title: str = "title") -> DataFrame:
    """Adds ``known``: the places of ``registered`` (``place``) among an entry's place phrases. A join, so any number may be registered."""
    parts = entries.select(*keys, F.explode(place_parts(F.concat_ws(". ", title, text))).alias("place"))
    found = parts.join(registered.select("place").distinct(), "place").groupBy(*keys).agg(F.collect_set("place").alias("known"))
    return entries.join(found, keys, "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>")))


def water_bodies(found: Column) -> Column:
    return F.filter(found, lambda p: p.rlike(uni(rf"\b({vocab.GEO_WORDS})\b")))


def countries(text: Column, mentions: dict[str, str] = vocab.COUNTRY_MENTIONS) -> Column:
    """Countries named, in their usual name, first seen first."""
    body = "|".join(m.replace(".", r"\.") for m in sorted(mentions, key=lambda m: (-len(m), m)))
    table = F.create_map(*[F.lit(x) for pair in mentions.items() for x in pair])
    return F.array_distinct(F.transform(find_all(text, uni(rf"\b({body})\b"), 1), lambda m: F.coalesce(F.try_element_at(table, m), m)))


def coordinates(text: Column) -> Column:
    return F.array_distinct(find_all(text, uni(vocab.COORDINATES)))


def depths(text: Column) -> Column:
    groups = [find_all(text, uni(vocab.DEPTH, True), i) for i in (1, 2, 3)]
    both = F.arrays_zip(*[g.alias(f"g{i}") for i, g in enumerate(groups)])
    return F.array_distinct(F.transform(both, lambda x: F.concat(F.coalesce(*[F.nullif(x[f"g{i}"], F.lit("")) for i in range(3)]), F.lit(" m"))))


def offshore(text: Column) -> Column:
    return F.array_distinct(F.zip_with(find_all(text, uni(vocab.OFFSHORE, True), 1), find_all(text, uni(vocab.OFFSHORE, True), 2), lambda n, u: F.concat(n, F.lit(" "), u)))


def registered_places(location: Column) -> Column:
    """Place names a site's location field adds to the known ones."""
    parts = F.transform(F.split(F.coalesce(location, F.lit("")), r"[,/;]| in | of the "), T.strip)
    return F.filter(parts, lambda p: p.rlike(uni(r"^\p{Lu}")))


def describe(df: DataFrame, text: str = "text", title: str = "title") -> DataFrame:
    """Adds the attributes of an entry as arrays. A column ``known`` has further place names (``known_places``)."""
    both, place_text = F.concat_ws(" ", title, text), F.concat_ws(". ", title, text)
    out = df.withColumns(
        {
            "capacities": F.array_distinct(capacities(both)),
            "technologies": labels(both, vocab.TECHNOLOGIES),
            "status": labels(both, vocab.STATUS),
            "years": years(both),
            "entities": named_entities(F.col(text)),
            "places": places(place_text, F.col("known") if "known" in df.columns else None),
            "countries": countries(place_text),
            "coordinates": coordinates(place_text),
            "depths": depths(place_text),
            "offshore": offshore(place_text),
        }
    )
    return out.withColumns({"water_bodies": water_bodies(F.col("places")), "name_guess": name_guess(F.col(title), F.col("entities"))})


def emit(entries: DataFrame, site_lines: DataFrame | None = None) -> DataFrame:
    """Project rows of entries: texts of 40 characters or more that tell enough, by the mode of their chapter.

    Chapters with a project section give only the entries of such sections (score 1 or more); other chapters, and texts without any, every entry with a
    score of 2, a verb of deployment and a capacity or a site. ``site_lines``: ``doc_id``, ``line_no`` of site mentions.
    """
    if site_lines is None:
        e = entries.withColumn("has_site", F.lit(False))
    else:
        per_doc = site_lines.groupBy("doc_id").agg(F.collect_set("line_no").alias("_sites"))
        e = entries.join(per_doc, "doc_id", "left").withColumn("has_site", F.coalesce(F.exists("_sites", lambda n: (n + 1 >= F.col("line_start")) & (n + 1 <= F.col("line_end"))), F.lit(False))).drop("_sites")
    e = e.where(F.length("text") >= 40).withColumn("signal_score", signal_score(F.col("text"), F.col("has_site")))
    in_project = F.col("section_kind").isin(*vocab.PROJECT_KINDS) & (F.col("country") != "")
    strong = (F.col("signal_score") >= 2) & has(F.col("text"), vocab.DEPLOY_VERB) & (has(F.col("text"), vocab.CAPACITY, False) | F.col("has_site"))
    e = e.withColumn("method", F.when(F.coalesce(in_project, F.lit(False)), "project section").otherwise("keyword scan"))
    return e.where(F.when(F.col("method") == "project section", F.col("signal_score") >= 1).otherwise(strong))


def mode_of_chapter(rows: DataFrame) -> DataFrame:
    """Lines to read: of a chapter with project sections only those, of another every line; without any chapter the whole text."""
    from pyspark.sql import Window

    kinds = F.coalesce(F.col("section_kind").isin(*vocab.PROJECT_KINDS), F.lit(False))
    any_project = F.max(kinds).over(Window.partitionBy("doc_id", "country"))
    any_chapter = F.max(F.col("country") != "").over(Window.partitionBy("doc_id"))
    r = rows.withColumns({"_p": any_project, "_c": any_chapter})
    return r.withColumn("wanted", F.when(F.col("country") != "", ~F.col("_p") | kinds).otherwise(~F.col("_c"))).drop("_p", "_c")
