"""Quantities recorded in different units: parsed from text, decoded per device, converted to one unit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.missing import is_missing, trimmed
from ..session import cut_lineage

# Units of power and watts per unit.
WATTS = {"W": 1.0, "kW": 1e3, "MW": 1e6, "GW": 1e9}
UNITS = tuple(WATTS)
# Number words before "units" or "machines".
NUMBER_WORDS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "twenty": 20}

_UNIT = r"(?:kilo-?\s?watts?|mega-?\s?watts?|giga-?\s?watts?|watts?|[kmg]?\s?w)"
_MARK = r"(?:\s?(?:\(el\.?\)|\(e\)|e|el\.?|p)(?![\p{L}]))?"
_NUM = r"\d{1,3}(?:[ '’\u00a0\u202f]\d{3})+(?:[.,]\d+)?(?!\d)|\d{1,3}(?:,\d{3})+(?:\.\d+)?(?!\d)|\d+(?:[.,]\d+)?(?:e[+-]?\d+)?"
_BEFORE = r"(?:(?:approx(?:\.|imately)?|about|around|circa|ca\.?|c\.|~|≈|up to|max(?:\.|imum)?|rated(?: at)?|nominal(?:ly)?|total(?: of)?|installed|nameplate|some|est\.|capacity(?: of)?|:)\s*)*"
_AFTER = r"(?:[\s,]*(?:\(nameplate\)|\(rated\)|\(installed\)|nameplate|installed|rated|power|capacity|electrical|total|max\.?|peak|each|apiece|in all|(?:units?|machines?|devices?|turbines?|generators?|converters?)(?: each)?))*"
_WHAT = r"(?:units?|machines?|devices?|turbines?|generators?|converters?)"
_COUNT = rf"(?:(\d+)\s*[x×*]\s*|(\d+|{'|'.join(NUMBER_WORDS)})\s+{_WHAT}\s+(?:of|at|with|,|x)\s+(?:up to\s+|about\s+)?|({'|'.join(NUMBER_WORDS)})\s+(?:x\s+)?)?"
QUANTITY = rf"(?iuU)^{_BEFORE}{_COUNT}{_BEFORE}({_NUM})(?:\s*-?\s*({_UNIT}){_MARK})?{_AFTER}[\s.]*$"
UNIT_ALONE = rf"(?iuU)^\s*({_UNIT}){_MARK}\.?\s*$"
UNIT_WITHIN = rf"(?iuU)(?<![\p{{L}}\d])({_UNIT}){_MARK}(?![\p{{L}}\d/])"


def _group(text: Column, pattern: str, k: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def unit_name(text: Column) -> Column:
    """``W``, ``kW``, ``MW`` or ``GW`` of a unit as written, null if it is none."""
    first = F.lower(F.substring(F.regexp_replace(text, r"\s", ""), 1, 1))
    return F.when(first == "k", "kW").when(first == "m", "MW").when(first == "g", "GW").when(first == "w", "W")


def number_value(text: Column) -> Column:
    """A number as written: blanks and apostrophes group; a comma groups before exactly three digits, else is a decimal mark."""
    plain = F.regexp_replace(text, r"(?U)[\s'’]", "")
    plain = F.when(plain.rlike(r"^\d{1,3}(,\d{3})+(\.\d+)?$"), F.replace(plain, F.lit(","), F.lit(""))).otherwise(F.replace(plain, F.lit(","), F.lit(".")))
    return plain.try_cast("double")


def parse_quantity(df: DataFrame, value: Column, unit: Column | None = None, hint: Column | None = None) -> DataFrame:
    """Adds ``magnitude`` (number of all units together), ``unit`` (null: not stated), ``is_power``, ``is_plain``.

    ``unit`` is a unit's own column, ``hint`` a text that may name one. A unit in the value's text counts first. A figure of
    something else (energy, weight, length) and a value with words the grammar lacks are no power. All in the JVM.
    """
    words = F.create_map(*[F.lit(x) for pair in NUMBER_WORDS.items() for x in pair])

    def read(text: Column) -> Column:
        count = F.coalesce(_group(text, QUANTITY, 1), _group(text, QUANTITY, 2), _group(text, QUANTITY, 3))
        return F.struct(count.alias("count"), _group(text, QUANTITY, 4).alias("number"), _group(text, QUANTITY, 5).alias("unit"), F.coalesce(text.rlike(r"^\d+(\.\d*)?$"), F.lit(False)).alias("is_plain"))

    def total(parts: Column) -> Column:
        times = F.coalesce(parts["count"].try_cast("double"), F.try_element_at(words, F.lower(parts["count"])).cast("double"), F.lit(1.0))
        return F.struct((number_value(parts["number"]) * times).alias("magnitude"), unit_name(parts["unit"]).alias("unit"), parts["is_plain"].alias("is_plain"))

    df = df.withColumn("_q", _let(_let(F.when(~is_missing(value), trimmed(value)), read), total))
    own, foreign, other = F.col("_q.unit"), F.lit(False), F.lit(None).cast("string")
    if unit is not None:
        df = df.withColumn("_u", _let(F.when(~(is_missing(unit) | F.lower(trimmed(unit)).isin("see value", "as stated")), unit), lambda u: F.struct(u.isNotNull().alias("given"), unit_name(_group(u, UNIT_ALONE, 1)).alias("name"))))
        other = F.col("_u.name")
        foreign = F.col("_u.given") & other.isNull()
    if hint is not None:
        other = F.coalesce(other, _let(F.when(~is_missing(hint), hint), lambda h: unit_name(_group(h, UNIT_WITHIN, 1))))
    magnitude = F.col("_q.magnitude")
    return df.withColumns({"magnitude": magnitude, "unit": F.coalesce(own, other), "is_power": magnitude.isNotNull() & ~(foreign & own.isNull()), "is_plain": F.col("_q.is_plain")}).drop("_q", "_u")


class UnitModel:
    """Hidden Markov model of one device's records: the unit is the state, the value moves along a smooth level.

    A stated unit speaks for its state by ``log_stated``, which is finite: where the values before and after agree with each
    other and the stated unit breaks the level by a power of ten, Viterbi puts it right. Where none is stated, ``default`` is
    preferred by ``log_default`` (the register's rule for its field; 0 leaves it to the level). Staying in a unit is preferred by
    ``log_stay``. The jump between the true values of two rows (in decades) has spread ``spread``, or is a new level at the cost
    ``log_level``, so a single neighbour (one jump saved) never outweighs a stated unit and two that agree (two jumps) do.
    """

    def __init__(self, log_stay: float = 0.5, spread: float = 0.05, log_stated: float = 13.0, log_level: float = 8.0):
        self.log_stay, self.spread, self.log_stated, self.log_level = log_stay, spread, log_stated, log_level
        self.scale = np.log10(list(WATTS.values()))

    def emissions(self, stated: np.ndarray, default: np.ndarray, log_default: np.ndarray) -> np.ndarray:
        """Log odds of each unit at each row."""
        n = len(stated)
        emit = np.zeros((n, len(self.scale)))
        emit[np.arange(n), default] += np.maximum(log_default, 0.1)  # of equal levels the usual unit
        known = stated >= 0
        emit[known] = -self.log_stated
        emit[np.flatnonzero(known), stated[known]] = 0
        return emit

    def steps(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Log odds of going from each unit (second last axis) to each (last axis), between rows of these log values."""
        jump = ((after[..., None] + self.scale)[..., None, :] - (before[..., None] + self.scale)[..., :, None]) / self.spread
        return self.log_stay * np.eye(len(self.scale)) - np.minimum(0.5 * jump * jump, self.log_level)

    def decode(self, chain: np.ndarray, log_value: np.ndarray, stated: np.ndarray, default: np.ndarray, log_default: np.ndarray, ends: dict[int, tuple[int, int]] | None = None) -> np.ndarray:
        """The most likely unit (index in ``UNITS``) of each row; rows of a chain stand together, in order.

        ``ends`` fixes the first and the last unit of chains, by the place of their first row.
        """
        n, k = len(chain), len(self.scale)
        if n == 0:
            return np.zeros(0, int)
        begin = np.append(True, chain[1:] != chain[:-1])
        first = np.flatnonzero(begin)
        length = np.diff(np.append(first, n))
        emit = self.emissions(stated, default, log_default)
        for at, (_, stop) in zip(first, [*zip(first, first + length)]):
            if ends and int(at) in ends:
                a, b = ends[int(at)]
                emit[at, np.arange(k) != a] = -np.inf
                emit[stop - 1, np.arange(k) != b] = -np.inf
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        score, back = emit[first].copy(), np.zeros((n, k), int)
        finals = {}
        for t in range(1, int(length[0])):  # all chains of the batch step together
            live = int(np.searchsorted(-length, -t, side="left"))
            if live < len(score):
                finals |= {int(i): score[i] for i in range(live, len(score))}
                score = score[:live]
            at = first[:live] + t
            step = score[:, :, None] + self.steps(log_value[at - 1], log_value[at])
            back[at] = step.argmax(1)
            score = step.max(1) + emit[at]
        finals |= {int(i): score[i] for i in range(len(score))}
        best = np.zeros(n, int)
        last = np.array([finals[i].argmax() for i in range(len(first))])
        for t in range(int(length[0]) - 1, -1, -1):
            live = int(np.searchsorted(-length, -t, side="left"))
            at = first[:live] + t
            final = length[:live] == t + 1
            best[at[final]] = last[:live][final]
            more = ~final
            best[at[more]] = back[at[more] + 1, best[at[more] + 1]]
        return best

    def transfer(self, log_value: np.ndarray, emit: np.ndarray) -> np.ndarray:
        """The best log odds of a stretch of one chain, from each first unit to each last one: steps composed by (max, +)."""
        whole = np.where(np.eye(len(self.scale), dtype=bool), emit[0], -np.inf)
        for step, e in zip(self.steps(log_value[:-1], log_value[1:]), emit[1:]):
            whole = (whole[:, :, None] + step[None]).max(1) + e
        return whole


_CODE = {u: i for i, u in enumerate(UNITS)}


def _arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    value = np.log10(pdf["magnitude"].to_numpy(float))
    return value, pdf["unit"].map(_CODE).fillna(-1).to_numpy(int), pdf["default_unit"].map(_CODE).fillna(1).to_numpy(int), pdf["log_default"].to_numpy(float)


def _decoded(pdf: pd.DataFrame, best: np.ndarray, columns: list[str]) -> pd.DataFrame:
    """``pdf`` with ``watts``, ``decoded_unit`` and what it rests on."""
    _, stated, default, _ = _arrays(pdf)
    basis = np.where(stated >= 0, np.where(stated == best, "stated", "level, against the stated unit"), np.where(default == best, "usual unit", "level"))
    return pdf.assign(watts=pdf["magnitude"].to_numpy(float) * np.array(list(WATTS.values()))[best], decoded_unit=np.array(UNITS)[best], unit_basis=basis)[[*columns, "watts", "decoded_unit", "unit_basis"]]


def _stretches(pdf: pd.DataFrame) -> list[tuple[int, int]]:
    """The ranges of rows with one chain."""
    cut = np.flatnonzero(pdf["_chain"].to_numpy()[1:] != pdf["_chain"].to_numpy()[:-1]) + 1
    return list(zip([0, *cut], [*cut, len(pdf)])) if len(pdf) else []


def _bounded(power: DataFrame, columns: list[str], order: list, schema, model: UnitModel) -> DataFrame:
    """Chains that fit a task, each whole in one."""
    ordered = power.repartition("_chain").sortWithinPartitions("_chain", *order)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if len(pdf) == 0:
                continue
            tail = pdf["_chain"] == pdf["_chain"].iloc[-1]
            rest = pdf[tail]
            if (~tail).any():
                yield solve(pdf[~tail].reset_index(drop=True))
        if rest is not None and len(rest):
            yield solve(rest.reset_index(drop=True))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        return _decoded(pdf, model.decode(pd.factorize(pdf["_chain"])[0], *_arrays(pdf)), columns)

    return ordered.mapInPandas(run, schema)


def _unbounded(power: DataFrame, columns: list[str], order: list, schema, model: UnitModel) -> DataFrame:
    """Chains of any length, cut into stretches in their order.

    Every task sends the transfer matrices of its first and last stretch to the driver, two rows of 16 numbers a task; there
    they are composed along each chain, which settles the units at the cuts, and every stretch is then decoded between them.
    """
    ordered = cut_lineage(power.repartitionByRange("_chain", *order).sortWithinPartitions("_chain", *order).withColumn("_part", F.spark_partition_id()))

    def whole(frames: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
        parts = [f for f in frames if len(f)]
        return pd.concat(parts, ignore_index=True) if parts else None

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf, rows = whole(frames), []
        if pdf is not None:
            part = int(pdf["_part"].iloc[0])
            ranges = _stretches(pdf)
            for which, (a, b) in {0: ranges[0], len(ranges) - 1: ranges[-1]}.items():
                value, *rest = _arrays(pdf.iloc[a:b])
                rows.append((part, which, pdf["_chain"].iloc[a], value[0], value[-1], model.transfer(value, model.emissions(*rest)).ravel().tolist()))
        yield pd.DataFrame(rows, columns=["part", "which", "chain", "head", "tail", "m"])

    cuts = sorted(ordered.mapInPandas(sums, "part int, which int, chain string, head double, tail double, m array<double>").collect(), key=lambda r: (r["part"], r["which"]))
    ends: dict[int, dict[int, tuple[int, int]]] = {}
    k, at = len(model.scale), 0
    while at < len(cuts):
        stop = at + 1
        while stop < len(cuts) and cuts[stop]["chain"] == cuts[at]["chain"]:
            stop += 1
        run, score, back = cuts[at:stop], np.zeros(k), []
        for i, r in enumerate(run):
            if i:
                step = score[:, None] + model.steps(np.array(run[i - 1]["tail"]), np.array(r["head"]))
                back.append(("cut", step.argmax(0)))
                score = step.max(0)
            inside = score[:, None] + np.array(r["m"]).reshape(k, k)
            back.append(("stretch", inside.argmax(0)))
            score = inside.max(0)
        state = int(score.argmax())
        for r in reversed(run):
            last = state
            state = int(back.pop()[1][last])
            ends.setdefault(r["part"], {})[r["which"]] = (state, last)
            if back:
                state = int(back.pop()[1][state])
        at = stop

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if (pdf := whole(frames)) is not None:
            fixed = {_stretches(pdf)[which][0]: states for which, states in ends[int(pdf["_part"].iloc[0])].items()}
            yield _decoded(pdf, model.decode(pd.factorize(pdf["_chain"])[0], *_arrays(pdf), ends=fixed), columns)

    return ordered.mapInPandas(solve, schema)


def decode_units(parsed: DataFrame, chain: str, order: str, row_key: list[str], max_chain: int = 4096, model: UnitModel | None = None) -> DataFrame:
    """``parsed`` (of ``parse_quantity``, with ``default_unit`` and ``log_default``) with ``watts``, ``decoded_unit``, ``unit_basis``; rows that are no power, zero or null are left out.

    Rows of a chain follow one another by ``order``, then ``row_key`` and the figure. A chain of more than ``max_chain`` rows, so
    one that holds a third of all, spreads over tasks in stretches of its order, with the same result. Rows of a null chain form one
    chain, repeated rows count each; columns named as the results, ``_n``, ``_chain`` or ``_part`` are replaced. ``unit_basis``: the stated
    unit, the level against it, the usual unit where none is stated, or the level.
    """
    model = model or UnitModel()
    columns = [c for c in parsed.columns if c not in ("watts", "decoded_unit", "unit_basis", "_n", "_chain", "_part")]
    power = parsed.where("is_power and magnitude > 0").select(*columns, F.coalesce(F.col(chain).cast("string"), F.lit("")).alias("_chain"))
    schema = power.select(*columns, F.lit(0.0).alias("watts"), F.lit("").alias("decoded_unit"), F.lit("").alias("unit_basis")).schema
    along = [F.col(c) for c in dict.fromkeys([order, *row_key, "magnitude", "unit"])]
    large = power.groupBy("_chain").agg(F.count("*").alias("_n")).where(F.col("_n") > max_chain).select("_chain")
    large = cut_lineage(large)  # few rows: chains above the bound
    if large.isEmpty():
        return _bounded(power, columns, along, schema, model)
    return _bounded(power.join(large, "_chain", "left_anti"), columns, along, schema, model).unionByName(_unbounded(power.join(large, "_chain", "left_semi"), columns, along, schema, model))
