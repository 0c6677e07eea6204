"""Missing values and keys of registers whose fields are all strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Written forms of "no value", lower case.
PLACEHOLDERS = (
    "n/a", "na", "n.a.", "tbc", "tbd", "tba", "-", "--", "–", "—", "?", "??", "null", "none", "nil", "unknown",
    "not known", "n.k.", "not stated", "not available", "not given", "missing", "...", "…",
)

_OUTER_SPACE = r"(?U)^[\s\u200b\ufeff]+|[\s\u200b\ufeff]+$"


def trimmed(col: Column) -> Column:
    """``col`` without outer white space of any kind."""
    return F.regexp_replace(col, _OUTER_SPACE, "")


def is_missing(col: Column) -> Column:
    """True for null, blank and written placeholders; never null."""
    text = F.lower(trimmed(col.cast("string")))
    return col.isNull() | (text == "") | text.isin(*PLACEHOLDERS)


def present(col: Column) -> Column:
    """The trimmed value, null where it is missing."""
    return F.when(~is_missing(col), trimmed(col.cast("string")))


def key_upper(col: Column) -> Column:
    """A key in its usual upper-case form, null where missing."""
    return F.upper(present(col))


def key_lower(col: Column) -> Column:
    """A key in its usual lower-case form, null where missing."""
    return F.lower(present(col))
