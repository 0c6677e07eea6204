"""Dictionary scans: every phrase of a dictionary found in every text, with offsets.

A dictionary of at most ``AUTOMATON_LIMIT`` phrases is an automaton that travels to the tasks; of a larger one only a table of bits
travels, and spans that it lets through are joined with the phrases, so neither the driver nor a task ever holds it whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage

AUTOMATON_LIMIT = 50_000
# bits (as powers of 2) of the tables that tell the spans worth a join: 64 a phrase within these bounds
LEAST_BITS, MOST_BITS = 20, 26
KNOWN = 1 << 20  # first words whose checksums a task keeps
SPAN = "array<struct<a:int,b:int,term:string>>"
_EDGE = re.compile(r"[\w-]")
_RUN = re.compile(r"\s+")
# of a squeezed text: where a phrase may begin, with what lies before the first place where it may end; what lies before the next such place
_FIRST = re.compile(r"(?<![\w-])(?=([^ ][\w-]*))")
_NEXT = re.compile(r" ?[^ ][\w-]*")
# what Python takes for white space, for Spark's regular expressions
_BLANKS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def squeezed(text: Column) -> Column:
    """A phrase as the scans give it: runs of white space as one blank, none outside."""
    return F.trim(F.regexp_replace(text, _BLANKS, " "))


def _guarded(text: str, a: int, b: int) -> bool:
    return not (a > 0 and _EDGE.match(text[a - 1])) and not (b < len(text) and _EDGE.match(text[b]))


def _squeezed(text: str) -> tuple[str, Sequence[int]]:
    """The text with runs of white space as one blank, and the place of each character in the text."""
    flat = _RUN.sub(" ", text)
    if len(flat) == len(text):
        return flat, range(len(text) + 1)
    places: list[int] = []
    last = 0
    for m in _RUN.finditer(text):
        places.extend(range(last, m.start() + 1))
        last = m.end()
    places.extend(range(last, len(text) + 1))
    return flat, places


def claim_longest(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The longest phrases claim their places first, in text order; what overlaps a claim is dropped."""
    taken: list[tuple[int, int, str]] = []
    for a, b, t in sorted(found, key=lambda x: (-len(x[2]), x[2], x[0])):
        if all(b <= c or a >= d for c, d, _ in taken):
            taken.append((a, b, t))
    return sorted(taken)


def leftmost(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The leftmost match, the longest that begins there, then on from its end."""
    out: list[tuple[int, int, str]] = []
    for a, b, t in sorted(found, key=lambda x: (x[0], -len(x[2]))):
        if not out or a >= out[-1][1]:
            out.append((a, b, t))
    return out


POLICIES = {"longest": claim_longest, "leftmost": leftmost, "all": sorted}


def scan(texts: DataFrame, phrases: list[str], policy: str = "longest", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``a``, ``b``, ``term``: matches of at most ``AUTOMATON_LIMIT`` phrases, word edges guarded, overlaps settled by ``policy``."""
    if len(phrases) > AUTOMATON_LIMIT:
        raise ValueError("too many phrases for an automaton: use scan_table")
    schema = texts.select(F.col(key), F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit("").alias("term")).schema
    settle = POLICIES[policy]
    terms = sorted({" ".join(p.split()) for p in phrases if p and p.strip()})
    kept = texts.sparkSession.sparkContext.broadcast({"terms": terms})  # AUTOMATON_LIMIT bounds it

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = kept.value
        if "automaton" not in state:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for t in state["terms"]:
                automaton.add_word(t, t)
            if state["terms"]:
                automaton.make_automaton()
            state["automaton"] = automaton
        automaton = state["automaton"]
        for pdf in frames:
            rows = []
            for k, body in zip(pdf[key], pdf[text]):
                if not body or not state["terms"]:
                    continue
                flat, places = _squeezed(body)
                found = [(e + 1 - len(t), e + 1, t) for e, t in automaton.iter(flat)]
                found = [(a, b, t) for a, b, t in found if _guarded(flat, a, b)]
                rows += [(k, places[a], places[b - 1] + 1, t) for a, b, t in settle(found)]
            yield pd.DataFrame(rows, columns=[key, "a", "b", "term"])

    return texts.select(key, text).mapInPandas(run, schema)


def _prefixes(term: str) -> Iterator[int]:
    """A running checksum of what lies before each place in a squeezed ``term`` where a phrase may end; the last is of all of it."""
    at, told = 0, 0
    while m := _NEXT.match(term, at):
        told, at = zlib.crc32(m.group().encode("utf-8", "surrogatepass"), told), m.end()
        yield told


def scan_table(texts: DataFrame, phrases: DataFrame, policy: str = "longest", key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``scan``, for a dictionary of any size in ``phrases`` (``term``): a text tells the spans that may be phrases, an equi-join on the span which are.

    From each place where a phrase may begin a text is read on as long as the checksum of what was read is in a table of bits that all
    phrases' beginnings set; spans whose checksum a whole phrase set are put out. Checksums lose no phrase, and the few spans that
    only look like one meet none in the join. Neither texts nor the words of phrases not found are moved. ``key`` is that of one text.
    """
    split = cut_lineage(phrases.select(squeezed(F.col("term")).alias("term")).where("term <> ''").distinct())  # counted, told in bits and joined
    settle = POLICIES[policy]
    many = split.count()
    size = 1 << min(MOST_BITS, max(LEAST_BITS, (64 * many).bit_length()))

    def bits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a bit of each kind by number, packed, once a task: few bytes, however many phrases begin alike
        begun, whole = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        for pdf in frames:
            for t in pdf["term"]:
                last = None
                for told in _prefixes(t):
                    last = told & (size - 1)
                    begun[last] = True
                if last is not None:
                    whole[last] = True
        for kind, table in enumerate((begun, whole)):
            yield pd.DataFrame({"kind": [kind], "bits": [zlib.compress(np.packbits(table).tobytes(), 1)]})

    tables = [np.zeros(size // 8, dtype=np.uint8), np.zeros(size // 8, dtype=np.uint8)]
    for r in split.coalesce(16).mapInPandas(bits, "kind int, bits binary").toLocalIterator():
        tables[r["kind"]] |= np.frombuffer(zlib.decompress(r["bits"]), dtype=np.uint8)
    kept = texts.sparkSession.sparkContext.broadcast([t.tobytes() for t in tables])  # MOST_BITS bounds it
    out_schema = texts.select(F.col(key), F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit("").alias("term")).schema

    def seen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begun, whole = kept.value
        crc, mask, known = zlib.crc32, size - 1, {}
        has = lambda table, told: table[(told & mask) >> 3] >> (7 - (told & 7)) & 1
        for pdf in frames:
            rows = []
            for k, body in zip(pdf[key], pdf[text]):
                if not body:
                    continue
                flat, places = _squeezed(body)
                for m in _FIRST.finditer(flat):
                    word = m[1]
                    told = known.get(word)
                    if told is None:
                        told = crc(word.encode("utf-8", "surrogatepass"))
                        told = known[word] = told if has(begun, told) else -1
                    if told < 0:  # the usual case
                        continue
                    a = m.start()
                    e = a + len(word)
                    while True:
                        if has(whole, told):
                            rows.append((k, places[a], places[e - 1] + 1, flat[a:e]))
                        n = _NEXT.match(flat, e)
                        if n is None:
                            break
                        told, e = crc(n.group().encode("utf-8", "surrogatepass"), told), n.end()
                        if not has(begun, told):
                            break
            known = known if len(known) < KNOWN else {}
            yield pd.DataFrame(rows, columns=[key, "a", "b", "term"])

    met = texts.select(key, text).mapInPandas(seen, out_schema).join(split, "term", "left_semi").select(key, "a", "b", "term")
    if policy == "all":  # overlaps stay
        return cut_lineage(met)
    found = met.groupBy(key).agg(F.collect_list(F.struct("a", "b", "term")).alias("_found"))

    def settle_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(k, a, b, t) for k, spots in zip(pdf[key], pdf["_found"]) for a, b, t in settle([(x["a"], x["b"], x["term"]) for x in spots])]
            yield pd.DataFrame(rows, columns=[key, "a", "b", "term"])

    # few rows, read more than once by those that resolve them
    return cut_lineage(found.mapInPandas(settle_all, out_schema))


def scan_any(texts: DataFrame, phrases: DataFrame, policy: str = "longest", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``scan`` if the dictionary's counted size allows it, else ``scan_table``."""
    terms = phrases.select("term").where("term is not null and trim(term) <> ''").distinct()
    first = terms.limit(AUTOMATON_LIMIT + 1).toPandas()["term"].tolist()
    return scan(texts, first, policy, key, text) if len(first) <= AUTOMATON_LIMIT else scan_table(texts, terms, policy, key, text)


def not_overlapping(found: DataFrame, claimed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Spans of ``found`` that overlap none of ``claimed`` of the same document."""
    taken = claimed.groupBy(key).agg(F.collect_list(F.struct("a", "b")).alias("_t"))
    out = found.join(taken, key, "left")
    return out.where(F.col("_t").isNull() | ~F.exists("_t", lambda t: (F.col("a") < t["b"]) & (F.col("b") > t["a"]))).drop("_t")
