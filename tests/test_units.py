import numpy as np
import pytest
from docengine.operators import units
from pyspark.sql import functions as F

# value, unit, hint -> watts (None: no power); plain
CASES = [
    ("100", None, None, (100.0, None, True)),
    ("1,000", None, None, (1000.0, None, False)),
    ("1 500", None, None, (1500.0, None, False)),
    ("2,5", "MW", None, (2.5, "MW", False)),
    ("12'000", "kW", None, (12000.0, "kW", False)),
    ("1.5e3", "kW", None, (1500.0, "kW", False)),
    ("5 x 15 kW", None, None, (75.0, "kW", False)),
    ("8×75kW", None, None, (600.0, "kW", False)),
    ("two 60 kW units", None, None, (120.0, "kW", False)),
    ("five machines of 9 kW each", None, None, (45.0, "kW", False)),
    ("approx. 0.4 MW (nameplate)", "see value", None, (0.4, "MW", False)),
    ("75 kWe", None, None, (75.0, "kW", False)),
    ("10-kW", None, None, (10.0, "kW", False)),
    ("0.5MW installed", None, None, (0.5, "MW", False)),
    ("900000 watts", None, None, (900000.0, "W", False)),
    ("0.9 mw", None, None, (0.9, "MW", False)),
    ("1.1", None, "PRIMRE, figure in MW", (1.1, "MW", True)),
    ("7500", None, "nameplate in W", (7500.0, "W", True)),
    ("80", None, "report (kW)", (80.0, "kW", True)),
    ("9 m rotor", None, None, None),
    ("720", "t", None, None),
    ("20", "GWh", None, None),
    ("1,100", "MWh/yr", None, None),
    ("3 MWh", None, None, None),
    ("tbc", "MW", None, None),
    (None, None, None, None),
    ("", "kW", None, None),
    ("50", "k W", None, (50.0, "kW", True)),
    ("50", "kW (el.)", None, (50.0, "kW", True)),
]


def test_parse(spark):
    df = spark.createDataFrame([(i, c[0], c[1], c[2]) for i, c in enumerate(CASES)], "i int, v string, u string, h string")
    got = {r.i: (r.magnitude, r.unit, r.is_plain) if r.is_power else None for r in units.parse_quantity(df, F.col("v"), F.col("u"), F.col("h")).collect()}
    for i, c in enumerate(CASES):
        want = c[3]
        assert (got[i] is None) == (want is None), c
        if want:
            assert got[i][0] == pytest.approx(want[0]) and got[i][1:] == want[1:], c


def test_viterbi_equals_every_path():
    import itertools

    model, rnd = units.UnitModel(), np.random.default_rng(1)
    k = len(units.UNITS)
    for _ in range(40):
        n = int(rnd.integers(1, 6))
        value, stated = rnd.uniform(-1, 6, n).round(1), rnd.integers(-1, k, n)
        got = model.decode(np.zeros(n), value, stated, np.ones(n, int), np.zeros(n))

        def score(path):
            total = 0.0
            for t, s in enumerate(path):
                total += (0.1 if s == 1 else 0) if stated[t] < 0 else 0 if stated[t] == s else -model.log_stated
                if t:
                    jump = (value[t] + model.scale[s] - value[t - 1] - model.scale[path[t - 1]]) / model.spread
                    total += model.log_stay * (s == path[t - 1]) - min(0.5 * jump * jump, model.log_level)
            return total

        best = max(score(p) for p in itertools.product(range(k), repeat=n))
        assert score(tuple(got)) == pytest.approx(best)


def decoded(spark, rows, usual=0.0, **more):
    df = units.parse_quantity(spark.createDataFrame(rows, "dev string, ord int, v string, u string"), F.col("v"), F.col("u"))
    df = df.withColumns({"default_unit": F.lit("kW"), "log_default": F.lit(usual)})
    return {(r.dev, r.ord): (r.watts, r.unit_basis) for r in units.decode_units(df, "dev", "ord", ["ord"], **more).collect()}


def test_planted_unit_switches_are_put_right(spark):
    """A stated unit that breaks a level on which the rows before and after agree is no unit of this figure; a plain rule would keep it."""
    rnd, rows, truth, wrong = np.random.default_rng(5), [], {}, set()
    for d in range(60):
        level = 10 ** rnd.uniform(3.5, 7)
        for i in range(8):
            watts, unit = level * 10 ** rnd.normal(0, 0.01), rnd.choice(["kW", "MW"])
            factor, told = units.WATTS[unit], unit
            if i in (2, 5) and d % 2:
                told, factor = ("MW", 1e3) if unit == "kW" else ("kW", 1e6)
                wrong.add((str(d), i))
            rows.append((str(d), i, f"{watts / factor:.6f}", told))
            truth[str(d), i] = watts
    got = decoded(spark, rows)
    assert all(got[k][0] == pytest.approx(w, rel=1e-3) for k, w in truth.items())
    assert {k for k, (_, basis) in got.items() if basis == "level, against the stated unit"} == wrong
    # a level that truly changes keeps its stated units, as does a single figure against one neighbour
    kept = [("x", i, v, "kW") for i, v in enumerate(["5", "5", "5", "5000", "5000", "5000"])] + [("y", 0, "3", "kW"), ("y", 1, "3", "MW")]
    assert {b for _, b in decoded(spark, kept).values()} == {"stated"}


def test_cut_chains_decode_as_whole_ones(spark):
    rnd = np.random.default_rng(3)
    rows = [(str(rnd.integers(0, 4)) if i % 9 else None, i, f"{10 ** rnd.normal(2, 0.02):.3f}", rnd.choice(["W", "kW", "kW", "MW", None])) for i in range(400)]
    whole = decoded(spark, rows)
    assert len({b for _, b in whole.values()}) > 2
    for most in (1, 60):
        assert decoded(spark, rows, max_chain=most) == whole
    assert decoded(spark, [("one", i, v, u) for _, i, v, u in rows], max_chain=1) == decoded(spark, [("one", i, v, u) for _, i, v, u in rows])


def test_unit_from_level(spark):
    """A figure without a unit takes the unit that keeps the device's level."""
    rows = [("d", 1, "500", "kW"), ("d", 2, "0.5", None), ("d", 3, "510000", None), ("e", 1, "3", "MW"), ("e", 2, "3000", None)]
    df = units.parse_quantity(spark.createDataFrame(rows, "dev string, ord int, v string, u string"), F.col("v"), F.col("u"))
    df = df.withColumns({"default_unit": F.lit("kW"), "log_default": F.lit(0.0)})
    got = {(r.dev, r.ord): r.watts for r in units.decode_units(df, "dev", "ord", ["ord"]).collect()}
    assert got == {("d", 1): 5e5, ("d", 2): 5e5, ("d", 3): 510000, ("e", 1): 3e6, ("e", 2): 3e6}


def test_hot_chain_is_split_and_whole(spark):
    df = spark.range(3000).select(F.lit("hot").alias("dev"), "id", F.lit("5 kW").alias("v"))
    df = units.parse_quantity(df, F.col("v")).withColumns({"default_unit": F.lit("kW"), "log_default": F.lit(0.0)})
    out = units.decode_units(df, "dev", "id", ["id"], max_chain=100)
    assert out.count() == 3000 and out.where("watts <> 5000").count() == 0
    assert units.decode_units(df.limit(0), "dev", "id", ["id"]).count() == 0


def test_clashing_names_and_nulls(spark):
    df = spark.createDataFrame([(None, 1, "5", "kW", "w", 1.0), (None, 1, "5", "kW", "w", 1.0), ("d", None, "2 MW", None, None, None), ("d", 1, None, "kW", "w", 1.0), ("d", 1, "0", "kW", "w", 1.0)], "dev string, ord int, v string, unit string, is_power string, watts double")
    df = units.parse_quantity(df, F.col("v"), F.col("unit")).withColumns({"default_unit": F.lit("kW"), "log_default": F.lit(0.0)})
    assert sorted(r.watts for r in units.decode_units(df, "dev", "ord", ["v"]).collect()) == [5000.0, 5000.0, 2e6]


def test_query_cases(spark, sf):
    """Every stated power that is no plain figure of kW is a case, with the watts a plain reading gives."""
    from docengine.plans.data_queries import p4_found

    got = {(r.src, r.row_key): r.capacity_w for r in p4_found(spark, sf).collect()}
    pilot = spark.read.parquet(f"{sf}/pilot_projects.parquet").collect()
    plain = {r.project_id: r for r in pilot if (r.capacity_max_value or "").replace(".", "", 1).isdigit()}
    factor = {"W": 1, "Watt": 1, "watts": 1, "kw": 1e3, "KW": 1e3, "kWe": 1e3, "MW": 1e6, "MWe": 1e6, "mw": 1e6, "megawatt": 1e6, "Megawatts": 1e6, "kilowatt": 1e3, "k W": 1e3, "kW (el.)": 1e3}
    for r in plain.values():
        if r.capacity_max_unit == "kW":
            assert ("pilot_projects", r.project_id) not in got
        elif (u := (r.capacity_max_unit or "").strip()) in factor:
            assert got["pilot_projects", r.project_id] == round(float(r.capacity_max_value) * factor[u])
