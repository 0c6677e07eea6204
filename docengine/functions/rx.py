"""Patterns for Spark's regular expressions with Unicode classes, as document code means them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def uni(pattern: str, ignore_case: bool = False) -> str:
    """``pattern`` with Unicode classes, and Unicode case folding if asked."""
    return f"(?{'iu' if ignore_case else ''}U){pattern}"


def quote(text: str) -> str:
    """``text`` as a literal of a pattern."""
    return "".join(c if c.isalnum() or c.isspace() or c in "'_" else "\\" + c for c in text)


def phrase(text: str) -> str:
    """A phrase as a pattern: any white space between words, no word character or hyphen on either side."""
    return rf"(?<![\w-]){r'\s+'.join(quote(w) for w in text.split())}(?![\w-])"


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a group, empty for null text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """``body`` of ``value``, computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def spans(text: Column, pattern: str) -> Column:
    """Array of (a, b, term) for the matches of ``pattern``, half-open, counted in code points.

    ``pattern`` must not match the empty string. Offsets follow from the lengths of what lies between the matches.
    """
    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), find_all(text, pattern).alias("hits"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int,term:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.length(x["gap"])
        b = a + F.length(x["hit"])
        return F.struct(b.alias("at"), F.concat(acc["out"], F.array(F.struct(a.alias("a"), b.alias("b"), x["hit"].alias("term")))).alias("out"))

    def walk(p: Column) -> Column:
        pairs = F.zip_with(F.slice(p["gaps"], 1, F.size(p["hits"])), p["hits"], lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
        return F.aggregate(pairs, start, step, lambda acc: acc["out"])

    return let(parts, walk)
