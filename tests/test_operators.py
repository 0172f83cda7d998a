"""Operators on hand-made frames, one case per trap."""

import datetime
import math
import random
from collections import Counter
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from agencylens.operators import calendar, cohort, latest, ledger, population, profiling, quality, quantile, ranking, ratios, rollup
from agencylens.operators import transitions, trend, visits
from agencylens.operators.score import Metric, agency_score
from agencylens.plans.rollup import agency_history_rollup
from agencylens.sources.codes import CONTACT_CODES, code_map


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- last record ----------------------------------------------------------------------


def test_last_record_forms_agree_and_break_ties(spark):
    data = [("a", 1, 5, 10, "x"), ("a", 1, 5, 11, "y"), ("a", 1, None, 99, "n"), ("b", 1, None, 1, "z")]
    df = spark.createDataFrame(data, "k string, p int, ts int, id int, v string")
    by_window = rows(latest.latest_per_key(df, ["k", "p"], ["ts"], ["id"]).select("k", "p", "v"), "k")
    by_max = rows(latest.latest_with_aggregates(df, ["k", "p"], ["ts"], ["v"], [F.count("*").alias("n")], ["id"]).select("k", "p", "v"), "k")
    assert by_window == by_max == [("a", 1, "y"), ("b", 1, "z")]


def test_last_record_limits_groups_before_the_shuffle(spark, plan_of):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(latest.latest_per_key(df, ["k"], ["id"]))
    below_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_exchange


# --- population -----------------------------------------------------------------------


def test_population_and_restriction(spark):
    snapshot = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 1, 5), ("c", 2, 1)], "entity_id string, period int, segment int")
    members = population.entity_population(snapshot, 1, [5])
    assert rows(members, "entity_id") == [("a",)]
    assert population.restrict_to(snapshot, members.union(members)).count() == 2


def test_entry_population_keeps_one_department(spark):
    snapshot = spark.createDataFrame(
        [("a", 3, 1, 20, 2), ("a", 3, 1, 10, 6), ("b", 3, 1, 10, 7), ("c", 3, 2, 10, 3)],
        "entity_id string, period int, segment int, department int, arrears int",
    )
    assert rows(population.entry_population(snapshot, 3, [10, 20]), "entity_id") == [("a", 10)]


# --- transitions ----------------------------------------------------------------------


def _timeline(spark):
    return spark.createDataFrame(
        [("a", 1, 1, 3, 10, 5), ("a", 2, 5, 4, None, -3), ("a", 5, 5, 3, 7, None), ("b", 2, 5, 1, 1, 1)],
        "entity_id string, period int, segment int, arrears int, last_payment int, last_arrears_payment int",
    )


def test_required_payment(spark):
    plain = rows(transitions.with_required_payment(_timeline(spark)).select("entity_id", "period", "required_payment"), "entity_id", "period")
    assert plain == [("a", 1, None), ("a", 2, 15), ("a", 5, -3), ("b", 2, None)]
    clamped = transitions.with_required_payment(_timeline(spark), clamped=True)
    assert rows(clamped.select("entity_id", "period", "required_payment"), "entity_id", "period") == [
        ("a", 1, 0), ("a", 2, 15), ("a", 5, 0), ("b", 2, 0),
    ]


def test_rolls_step_over_missing_periods(spark):
    rolled = transitions.with_arrears_roll(_timeline(spark)).select(
        "entity_id", "period", "prev_arrears", "next_arrears", "roll_forward", "roll_backward"
    )
    assert rows(rolled, "entity_id", "period") == [
        ("a", 1, None, 4, 0, 0), ("a", 2, 3, 3, 1, 1), ("a", 5, 4, None, 0, 0), ("b", 2, None, None, 0, 0),
    ]


def test_entering_needs_a_known_neighbour_outside(spark):
    moved = transitions.with_segment_transitions(_timeline(spark), [5, 6])
    assert rows(moved.select("entity_id", "period", "enter_legal", "out_legal", "in_legal"), "entity_id", "period") == [
        ("a", 1, 0, 0, 0), ("a", 2, 1, 0, 1), ("a", 5, 0, 0, 1), ("b", 2, 0, 0, 1),
    ]


def test_all_movements_share_one_sort(spark, plan_of):
    df = transitions.with_segment_transitions(transitions.with_arrears_roll(transitions.with_required_payment(_timeline(spark))), [5])
    plan = plan_of(df)
    assert plan.count("Sort [") == 1
    assert plan.count("Exchange") == 1


# --- ledger ---------------------------------------------------------------------------


def _ledger(spark):
    return spark.createDataFrame(
        [
            ("a", 1, 100, 5, -2, 1, 1, 7, "PLAN ACTIVO", 10, 1),
            ("a", 1, 200, 1, -4, 1, 1, 7, "x", 11, 2),
            ("a", 1, 100, 3, None, 1, None, 8, "PLAN ACTIVO", 9, 3),
            ("b", 1, None, 9, 9, 1, 1, 7, "x", 1, 4),
        ],
        "entity_id string, period int, agency long, capital int, interest int, auto_charge int, captation int, "
        "manager long, plan string, ts int, id int",
    )


def test_ledger_credits_the_last_records_agency(spark):
    got = ledger.ledger_by_entity_period(_ledger(spark), ["ts"], ["id"]).select(
        "entity_id", "period", "agency", "plan_active", "collected", "auto_charge", "captation", "n_managers", "paid"
    )
    assert rows(got, "entity_id") == [("a", 1, 200, 0, 3, 3, 2, 2, 1)]


def test_multi_channel_flag(spark):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 1, 2), ("b", 1, 1), ("b", 1, None), ("c", 1, None)], "entity_id string, period int, collection_type int"
    )
    assert rows(ledger.multi_channel_flag(df), "entity_id") == [("a", 1, 1), ("b", 1, 0), ("c", 1, 0)]


def test_cumulative_payment_never_falls(spark):
    df = spark.createDataFrame([("a", p, random.Random(p).randint(0, 9)) for p in range(20)], "entity_id string, period int, payment int")
    totals = [r[-1] for r in rows(ledger.with_cumulative_payment(df), "period")]
    assert totals == sorted(totals)
    assert totals[-1] == df.agg(F.sum("payment")).first()[0]


def test_actions_count_codes_from_800(spark):
    df = spark.createDataFrame([("a", 1, 800, 1), ("a", 1, 900, 1), ("a", 1, 799, 2)], "entity_id string, period int, action_code int, manager int")
    assert rows(ledger.actions_by_entity_period(df), "entity_id") == [("a", 1, 2, 1)]


def test_payment_flow_and_closing_state(spark):
    cash = spark.createDataFrame(
        [("a", 1, 5, 1, 10, 3, 1), ("a", 1, 5, 1, 20, 9, 2), ("a", None, 5, 1, 99, 1, 3)],
        "entity_id string, agency int, segment int, period int, payment int, days_late int, paid_at int",
    )
    with pytest.raises(ValueError, match="telephony_flag"):
        ledger.payment_flow_and_close(cash, ["paid_at"])
    got = ledger.payment_flow_and_close(cash, ["paid_at"], amounts=["payment"], state=["days_late"])
    assert rows(got.select("entity_id", "payment_paid", "n_payments_paid", "days_late_at_close"), "entity_id") == [("a", 30, 2, 9)]


# --- calendar -------------------------------------------------------------------------


def test_rollup_leaves_out_what_lies_before_its_start(spark):
    cash = spark.createDataFrame([("a", 1, 5, 2, 10, 3, 9)], "entity_id string, agency int, segment int, period int, payment int, days_late int, balance int")
    columns = {c: F.lit(0) for c in (*ledger.FLOW_AMOUNTS, *ledger.CLOSING_STATE) if c not in cash.columns}
    entries = "entity_id string, agency int, segment int, period int, capital int, interest int, days_late int, commission_pct double, n_actions int"
    booked = spark.createDataFrame([("a", 1, 5, p, 100 * p, 0, 1, 0.1, 1) for p in (1, 2)], entries)
    got = agency_history_rollup(booked, cash.withColumns(columns).withColumn("paid_at", F.lit(1)), 2, ["paid_at"], [])
    assert [tuple(r) for r in got.select("avg_capital", "avg_payment_paid").collect()] == [(200.0, 10.0)]


def test_actions_are_bounded_in_the_scan(spark, days, tmp_path, plan_of):
    path = str(tmp_path / "actions")
    spark.createDataFrame([("a", 20240107), ("a", 20240108), ("a", 20240131)], "entity_id string, yyyymmdd int").write.parquet(path)
    recent = calendar.dated_from(spark.read.parquet(path), days, 202402, "yyyymmdd")
    assert recent.count() == 2 and "GreaterThanOrEqual(yyyymmdd,20240108)" in plan_of(recent)
    assert calendar.dated_from(spark.read.parquet(path), days, 209901, "yyyymmdd").count() == 0


@pytest.fixture
def days(spark):
    start = datetime.date(2024, 1, 1)
    data = [(start + datetime.timedelta(days=i), 202401 + i // 7) for i in range(28)]
    return spark.createDataFrame(data, "day date, period int")


def test_period_around(days):
    assert calendar.find_period_around(days, 202404, 2) == 202402
    assert calendar.find_period_around(days, 202404, 9) == 202401
    assert calendar.find_period_around(days, 202401, 1) is None
    assert calendar.find_period_around(days, 202402, 1, forward=True) == 202403


def test_period_limits(days):
    assert calendar.find_period_limits(days, 202402) == (datetime.date(2024, 1, 8), datetime.date(2024, 1, 14))
    assert calendar.find_period_limits(days, 209901) == (None, None)


def test_period_of_date_on_and_outside_the_limits(spark, days, plan_of):
    dated = spark.createDataFrame([(20240101,), (20240107,), (20231231,), (20241399,)], "d int")
    limits = calendar.period_limits(days)
    found = calendar.with_period_of_date(dated, limits, "d")
    assert rows(found, "d") == [(20231231, None), (20240101, 202401), (20240107, 202401), (20241399, None)]
    assert "NestedLoop" not in plan_of(found)


def test_period_of_date_equals_the_range_join(spark, days):
    start = datetime.date(2023, 12, 20)
    numbers = [(int((start + datetime.timedelta(days=i)).strftime("%Y%m%d")),) for i in range(60)]
    dated = spark.createDataFrame(numbers, "d int")
    limits = calendar.period_limits(days)
    ours = rows(calendar.with_period_of_date(dated, limits, "d").select("d", "period"), "d")
    with_day = dated.withColumn("x", F.to_date(F.col("d").cast("string"), "yyyyMMdd"))
    ranged = with_day.join(limits, F.col("x").between(F.col("start_date"), F.col("end_date")), "left")
    assert ours == rows(ranged.select("d", "period"), "d")


# --- quality --------------------------------------------------------------------------


def test_sparse_rows(spark):
    names = [f"c{i}" for i in range(21)]
    kept = [0] * 11 + [1] * 10
    dropped = [None] * 6 + [0] * 6 + [1] * 9
    df = spark.createDataFrame([kept, dropped], ", ".join(f"{n} int" for n in names))
    assert quality.drop_sparse_rows(df).count() == 1


def test_capacity_bounds_skip_missing(spark):
    df = spark.createDataFrame([(3, None, None), (3, 5, 1)], "ideal_capacity int, min_capacity int, max_capacity int")
    assert rows(quality.enforce_capacity_bounds(df).select("min_capacity", "max_capacity"), "min_capacity") == [(3, 3), (3, 3)]


def test_status_dates(spark):
    df = spark.createDataFrame([(1, 5), (0, None), (0, 7), (None, 8)], "status int, end_ms long")
    assert [r[1] for r in rows(quality.repair_status_dates(df, 99), "end_ms")] == [None, 7, 8, 99]


def test_outliers_and_medians(spark):
    df = spark.createDataFrame([(1, i) for i in range(101)] + [(2, 0)], "segment int, ideal_capacity int")
    unlisted = spark.createDataFrame([(None, 4), (None, None), (77, 6), (77, None)], "segment int, ideal_capacity int")
    assert rows(quality.impute_group_medians(unlisted, ["ideal_capacity"]), "ideal_capacity") == [(None, 4), (None, 4), (77, 6), (77, 6)]
    cut = quality.null_outliers(df, ["ideal_capacity"])
    # 102 values: the 97th is 95, so 96 to 100 go, and both zeros
    assert cut.where("ideal_capacity IS NULL").count() == 5 + 2
    filled = quality.impute_group_medians(cut, ["ideal_capacity"])
    assert filled.where("segment = 1 AND ideal_capacity IS NULL").count() == 0
    assert filled.where("segment = 2").first()["ideal_capacity"] is None


def _by_rank(values, q):
    """The plain definition: sorted, at rank ceil(q n), the first at least."""
    known = sorted(v for v in values if v is not None)
    return known[max(1, math.ceil(Fraction(str(q)) * len(known))) - 1] if known else None


@pytest.mark.parametrize("q", [0, 0.05, 0.5, 0.95, 1])
def test_exact_quantiles_of_any_group(spark, q):
    """100,000 values in a group, ties, negatives, NULL groups and values, against sorting."""
    roll = random.Random(5)
    data = [("many", roll.randrange(-(10**9), 10**9), roll.choice([None, 1, 2, 2])) for _ in range(100_000)]
    data += [(None, v, None) for v in (3, 3, None, -1)] + [("none", None, None)] + [("tied", 7, v) for v in range(40)]
    df = spark.createDataFrame(data, "g string, a long, b int")
    found = {r["_group"]: (r["a"], r["b"]) for r in quantile.exact_quantiles(df, ["a", "b"], q, "g", buckets=16).collect()}
    assert found == {g: tuple(_by_rank([r[k] for r in data if r[0] == g], q) for k in (1, 2)) for g in ("many", "tied", None)}
    everything = quantile.exact_quantiles(df, ["a", "b"], q, buckets=16).collect()
    assert [tuple(r) for r in everything] == [tuple(_by_rank([r[k] for r in data], q) for k in (1, 2))]


def test_exact_quantiles_of_decimals_and_nan(spark):
    df = spark.createDataFrame([(Decimal(i) / 4, float("nan") if i > 5 else float(i)) for i in range(10)], "d decimal(12,2), x double")
    assert quantile.exact_quantiles(df, ["d"], 0.5).first()["d"] == Decimal("1.00")
    assert quantile.exact_quantiles(df, ["x"], 0.5).first()["x"] == 4.0
    assert math.isnan(quantile.exact_quantiles(df, ["x"], 0.9).first()["x"])
    assert [tuple(r) for r in quantile.exact_quantiles(df.limit(0), ["d"], 0.5).collect()] == [(None,)]
    for bad in (lambda: quantile.exact_quantiles(df, ["d", "x"], 0.5), lambda: quantile.exact_quantiles(df, ["d"], 2), lambda: quality.null_outliers(df, ["d"], method="?")):
        with pytest.raises((TypeError, ValueError)):
            bad()


def test_outliers_and_medians_by_rank_equal_the_sketch_where_that_is_exact(spark):
    df = spark.createDataFrame([(1, i) for i in range(101)] + [(2, 0), (None, None), (None, 9)], "segment int, ideal_capacity int")
    both = [quality.impute_group_medians(quality.null_outliers(df, ["ideal_capacity"], method=m), ["ideal_capacity"], method=m) for m in ("sketch", "exact")]
    assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))


def _scrambled(n):
    """Distinct numbers 1 to n, far more than a sketch holds, in no order."""
    return F.pmod(F.col("id") * 7919, F.lit(n)) + 1


def test_outliers_and_medians_are_exact_beyond_a_sketch(spark):
    n = 150_001
    df = spark.range(n).select((F.col("id") % 2).cast("int").alias("segment"), "id", _scrambled(n).alias("ideal_capacity"))
    cut = quality.null_outliers(df, ["ideal_capacity"])
    assert cut.agg(F.max("ideal_capacity"), F.count("ideal_capacity")).first() == (math.ceil(0.95 * n),) * 2
    values = {g: [r[0] for r in cut.where(f"segment = {g}").select("ideal_capacity").collect()] for g in (0, 1)}
    filled = quality.impute_group_medians(cut, ["ideal_capacity"]).join(cut.where("ideal_capacity IS NULL").select("id"), "id", "left_semi")
    assert {tuple(r) for r in filled.select("segment", "ideal_capacity").distinct().collect()} == {(g, _by_rank(v, 0.5)) for g, v in values.items()}


def test_trend_cut_points_are_exact_beyond_a_sketch(spark):
    n = 150_001
    value = _scrambled(n).cast("double")
    slopes = spark.range(n).select("id", *[(F.when(F.col("id") % 3 > 0, value) if k == 1 else value).alias(f"slope_{t}") for k, t in enumerate(trend.TRENDS.values())], value.alias("std_efficiency"))
    cuts = trend.cut_points(slopes).first()["_cuts"]
    gaps = [r[0] for r in slopes.select("slope_arrears").collect()]
    assert cuts["median_std_efficiency"] == 75_001
    assert (cuts["low_arrears"], cuts["high_arrears"]) == (_by_rank(gaps, 0.33), _by_rank(gaps, 0.66))
    assert {(cuts[f"low_{t}"], cuts[f"high_{t}"]) for t in trend.TRENDS.values() if t != "arrears"} == {(math.ceil(0.33 * n), math.ceil(0.66 * n))}


@pytest.mark.parametrize("q", [0, 0.05, 0.5, 0.95, 1])
def test_bracketed_quantiles_equal_the_selected_ones(spark, q):
    roll = random.Random(6)
    data = [("many", roll.gauss(0, 1), roll.choice([None, 1.0, float("nan"), -0.0])) for _ in range(60_000)]
    data += [(None, 3.0, None), (None, float("inf"), None), ("none", None, None)] + [("tied", 7.0, 7.0)] * 40
    df = spark.createDataFrame(data, "g string, a double, b double")
    for group in (None, "g"):
        selected = quantile.exact_quantiles(df, ["a", "b"], q, group)
        bracketed = quantile.bracketed_quantiles(df, {"a": ("a", q), "b": ("b", q)}, group)
        known = bracketed.where("a IS NOT NULL OR b IS NOT NULL")
        assert sorted(map(str, selected.select(known.columns).collect())) == sorted(map(str, known.collect()))
    assert [tuple(r) for r in quantile.bracketed_quantiles(df.limit(0), {"x": ("a", q)}).collect()] == [(None,)]


def test_all_missing_capacity_is_no_failure(spark):
    df = spark.createDataFrame([(1, None)], "segment int, ideal_capacity int")
    for method in ("sketch", "exact"):
        assert quality.null_outliers(df, ["ideal_capacity"], method=method).first()["ideal_capacity"] is None


# --- population prefilter -------------------------------------------------------------


@pytest.mark.parametrize("bits", [64, 1000, 1 << 20])
def test_prefilter_keeps_the_result(spark, bits):
    df = spark.range(5000).selectExpr("CAST(nullif(id % 700, 3) AS STRING) AS entity_id", "id % 2 AS part", "id")
    chosen = spark.range(0, 700, 50).selectExpr("CAST(id AS STRING) AS entity_id", "id % 2 AS part")
    for on in ("entity_id", ["entity_id", "part"]):
        plain, filtered = population.restrict_to(df, chosen, on), population.restrict_to(df, chosen, on, prefilter_bits=bits)
        assert rows(plain, "id") == rows(filtered, "id") and filtered.columns == df.columns
    possible = population.possible_members(df, chosen, bits=bits).count()
    assert possible >= plain.count() and (bits < 1 << 20 or possible < 200)
    assert population.restrict_to(df, chosen.limit(0), prefilter_bits=bits).count() == 0


def test_prefilter_lies_below_the_exchange(spark, no_broadcast, plan_of):
    df, chosen = spark.range(1000).selectExpr("id AS entity_id", "id AS x"), spark.range(20).selectExpr("id AS entity_id")
    lines = plan_of(population.restrict_to(df, chosen, prefilter_bits=1 << 12)).splitlines()
    at = lambda *words: [i for i, line in enumerate(lines) if all(w in line for w in words)]
    merged, masks, exchanges = at("SortMergeJoin", "LeftSemi"), at("BroadcastHashJoin", "LeftSemi"), at("Exchange hashpartitioning(")
    assert merged[0] < exchanges[0] < masks[0]
    with pytest.raises(TypeError):
        population.restrict_to(df, chosen.selectExpr("CAST(entity_id AS INT) AS entity_id"), prefilter_bits=64)


# --- ratios and trends ----------------------------------------------------------------


def _history(spark, n=400, seed=3):
    rng = random.Random(seed)
    data, seen = [], set()
    while len(data) < n:
        key = (f"e{rng.randint(0, 40)}", rng.randint(1, 9))
        if key in seen:
            continue
        seen.add(key)
        flags = [rng.randint(0, 1) for _ in range(9)]
        data.append((*key, rng.randint(1, 3), rng.choice([5, 6]), rng.choice([None, 0, 1, 2]), rng.randint(0, 2), rng.randint(0, 6),
                     rng.randint(0, 50), rng.choice([None, 5, 10]), rng.randint(1, 90), *flags))
        if len(seen) >= 41 * 9:
            break
    return spark.createDataFrame(
        data,
        "entity_id string, period int, agency long, segment int, n_actions int, n_actions_unpaid int, arrears int, collected int, "
        "required_payment int, balance int, paid int, debt_settled int, lost_track int, out_legal int, enter_legal int, "
        "plan_active int, roll_forward int, with_prev_arrears int, with_next_arrears int",
    ).withColumn("roll_backward", F.col("roll_forward"))


def test_additive_distinct_counts_equal_count_distinct(spark):
    history = _history(spark)
    doubled = history.unionByName(history)  # repeated rows must not count twice either
    for by_period in (False, True):
        keys = ["agency", "segment"] + (["period"] if by_period else [])
        ours = ratios.agency_ratios(doubled, by_period).select(*keys, "n_clients", F.round("pct_clients_managed", 9))
        direct = doubled.groupBy(*keys).agg(
            F.countDistinct("entity_id").alias("n"), F.countDistinct(F.when(F.col("n_actions") > 0, F.col("entity_id"))).alias("m")
        )
        assert rows(ours, *keys) == rows(direct.select(*keys, "n", F.round(F.col("m") / F.col("n"), 9)), *keys)


def test_trend_labels_without_any_slope(spark):
    weekly = ratios.agency_ratios(_history(spark).where("period = 1"), by_period=True)
    labels = trend.trend_labels(trend.trend_slopes(weekly))
    assert {r["trend_efficiency"] for r in labels.collect()} == {"Insuficiente"}
    assert {r["stability_efficiency"] for r in labels.collect()} == {"Sin datos"}
    assert {r["trend_score"] for r in labels.collect()} == {0}


# --- score ----------------------------------------------------------------------------


def test_percentile_score_orientation_and_missing(spark):
    df = spark.createDataFrame([(1, 5, 3.0), (2, 5, 2.0), (3, 5, 1.0), (4, 5, None), (5, 6, 9.0)], "agency int, segment int, m double")
    scored = agency_score(df, {"m": Metric(1, 1), "absent": Metric(9, 1)})
    got = [(r["agency"], r["score_m_pct"] and round(r["score_m_pct"], 2)) for r in scored.orderBy("agency").collect()]
    assert got == [(1, 0.0), (2, 33.33), (3, 66.67), (4, None), (5, 0.0)]
    best = agency_score(df.where("m IS NOT NULL"), {"m": Metric(1, 1)}, orientation="higher_is_better")
    assert best.where("agency = 1").first()["band"] == "Élite"
    with pytest.raises(ValueError):
        agency_score(df, {"absent": Metric(1, 1)})


RANKED = {"a": 1, "b": -1, "n": 1, "m": -1}


def _both_ways(df, percent):
    return [
        sorted(map(str, ranking.with_ranks(df, "segment", RANKED, percent, "_r", m).collect()))
        for m in ("window", "split")
    ]


@pytest.mark.parametrize("percent", [True, False])
@pytest.mark.parametrize("buckets", [4, 256])
def test_split_ranks_equal_window_ranks(spark, monkeypatch, percent, buckets):
    monkeypatch.setattr(ranking, "BUCKETS", buckets)
    rng = random.Random(11)
    nan, big = float("nan"), 2**53
    # a third of all values are equal, some missing or NaN; neighbours beyond what a double tells apart;
    # missing keys, repeated rows, and a group of one row
    data = [
        (
            rng.choice([i, i, None]),
            rng.choice([4, 5, None]),
            rng.choice([0.0, None, nan, rng.random(), rng.random()]),
            rng.choice([1.0, rng.gauss(0, 5), -0.0, nan]),
            rng.choice([big, big + 1, big + 2, -big, None, 7]),
            rng.choice([Decimal("123456789012345678901234567890.01"), Decimal("123456789012345678901234567890.02"), None, Decimal(i)]),
        )
        for i in range(600)
    ]
    data += data[:50] + [(900, 6, 2.0, None, 1, None)]
    df = spark.createDataFrame(data, "agency int, segment int, a double, b double, n long, m decimal(38,2)")
    window, split = _both_ways(df, percent)
    assert window == split and len(split) == len(data)


def test_ranks_of_empty_and_odd_columns(spark):
    empty = spark.createDataFrame([], "agency int, segment int, a double, b double, n long, m decimal(38,2)")
    assert _both_ways(empty, True) == [[], []]
    with pytest.raises(TypeError):
        ranking.with_ranks(spark.sql("SELECT 1 segment, 'x' t"), "segment", {"t": 1}, True, "_r", "split")
    with pytest.raises(ValueError):
        ranking.with_ranks(empty, "segment", {"a": 1}, True, "_r", "auto")


def test_scoring_shuffles_once_for_all_metrics(spark, plan_of):
    df = spark.range(50).select("id", F.lit(5).alias("segment"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    ranked = ranking.with_ranks(df, "segment", {"a": 1, "b": 1}, True, "_r", "window")
    assert plan_of(ranked).count("Exchange") == 1


# --- visits ---------------------------------------------------------------------------


def test_contact_types(spark):
    named = [name for name, by_visit in CONTACT_CODES.items() for results in by_visit.values() for _ in results]
    pairs = spark.createDataFrame([(v, r) for v in range(0, 180) for r in range(0, 18)], "visit_code int, result_code int")
    counts = {r["contact_type"]: r["count"] for r in visits.with_contact_type(pairs, code_map(spark)).groupBy("contact_type").count().collect()}
    assert counts == {**Counter(named), "sin_info": 180 * 18 - len(named)} and len(named) == 83
    known = [(visit, result, name) for name, by_visit in CONTACT_CODES.items() for visit, results in by_visit.items() for result in results[:1]]
    some = spark.createDataFrame([(int(v), r, n) for v, r, n in known] + [(179, 17, "sin_info")], "visit_code int, result_code int, expected string")
    assert visits.with_contact_type(some, code_map(spark)).where("contact_type <> expected").count() == 0


def test_a_pair_named_twice_keeps_its_last_type():
    assert visits.flatten_codes({"x": {"1": [0]}, "y": {1: [0, 2]}}) == [(1, 0, "y"), (1, 2, "y")]


def test_on_site_needs_coordinates_nearness_and_time(spark):
    data = [
        (1, "19.0", "-99.0", "19.0005", "-99.0", 0, 120_000),
        (2, "19.0", "-99.0", "19.002", "-99.0", 0, 120_000),
        (3, "19.0", "-99.0", "19.0", "-99.0", 0, 30_000),
        (4, "0.0", "-99.0", "19.0", "-99.0", 0, 120_000),
    ]
    df = spark.createDataFrame(
        data, "id int, agent_lat string, agent_lon string, client_lat string, client_lon string, start_ms long, end_ms long"
    )
    assert [r["id"] for r in visits.valid_on_site(df).collect()] == [1]
    assert sorted(r["id"] for r in visits.valid_on_site(df, 0.5).collect()) == [1, 3]


# --- cohort ---------------------------------------------------------------------------

SNAPSHOT = "country int, channel int, branch int, folio int, period int, segment int, arrears int, balance int, ts int"


def test_filter_before_and_after_the_last_record_differ(spark):
    data = [(1, 1, 1, 7, 9, 4, 2, 10, 1), (1, 1, 1, 7, 10, 5, -1, 20, 1), (1, 1, 1, 7, 10, 3, 2, 30, 2)]
    df = spark.createDataFrame(data, SNAPSHOT)
    entered = cohort.entries_from_snapshots(df, 10, ["ts"], [])
    assert [(r["folio"], r["balance_at_entry"], r["arrears_at_entry"], r["prev_period"]) for r in entered.collect()] == [(7, 20, 0, 9)]
    assert cohort.cohort_arrears(df, 10, 10, ["ts"], []).count() == 0
    assert cohort.entries_from_snapshots(df.withColumn("country", F.lit(2)), 10, ["ts"], []).count() == 0


def test_followup_keeps_periods_without_payment(spark):
    key = (1, 1, 1, 7)
    arrears = spark.createDataFrame([(10, *key, 3, 5), (11, *key, 4, 5)], "period int, country int, channel int, branch int, folio int, arrears int, segment int")
    entries = spark.createDataFrame([(*key, 50, 3)], "country int, channel int, branch int, folio int, balance_at_entry int, arrears_at_entry int")
    paid = spark.createDataFrame([(11, *key, 5)], "period int, country int, channel int, branch int, folio int, payment int")
    left = spark.createDataFrame([(10, *key, 8)], "period int, country int, channel int, branch int, folio int, principal_balance int")
    got = cohort.cohort_followup(arrears, entries, paid, left, 10)
    assert rows(got.select("period", "payment", "principal_balance", "periods_since_entry"), "period") == [(10, None, 8, 0), (11, 5, None, 1)]


# --- profiling and roll-up ------------------------------------------------------------


def test_profile_equals_per_column_aggregates(spark, plan_of):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (2, None, None)], "a int, b double, c string")
    got = {r["column"]: (r["nulls"], r["distinct"], r["non_nulls"], r["pct_nulls"]) for r in profiling.column_profile(df).collect()}
    assert got == {"a": (0, 2, 3, 0.0), "b": (3, 0, 0, 100.0), "c": (1, 2, 2, 33.33)}
    assert plan_of(profiling.column_profile(df)).count("Scan") == 1


def test_profile_tells_values_apart(spark):
    df = spark.sql("SELECT * FROM VALUES (0.0D, array('a', null), struct(1, null)), (-0.0D, array('a', 'null'), struct(1, 'x')), (double('NaN'), null, null) AS t(d, l, s)")
    got = {r["column"]: (r["nulls"], r["distinct"]) for r in profiling.column_profile(df).collect()}
    expected = df.agg(*[F.countDistinct(c).alias(c) for c in ("d", "l")]).first()
    assert got == {"d": (0, expected["d"]), "l": (1, expected["l"]), "s": (1, 2)}


def test_profile_of_maps_and_no_rows(spark):
    df = spark.sql("SELECT * FROM VALUES (map('a', 0.0D, 'b', 1.0D), 'x'), (map('b', 1.0D, 'a', -0.0D), 'x'), (map('a', 1.0D), null), (null, '') AS t(m, `a.b`)").withColumnRenamed("a.b", "a_b")
    got = {r["column"]: (r["nulls"], r["distinct"], r["non_nulls"]) for r in profiling.column_profile(df).collect()}
    assert got == {"m": (1, 2, 3), "a_b": (1, 2, 3)}
    assert profiling.column_profile(df.limit(0)).collect() == []


def test_profile_shuffles_no_text_and_sketches_come_close(spark, plan_of):
    df = spark.range(20_000).selectExpr("IF(id % 4 = 0, NULL, id % 9000) AS a", "repeat(cast(id AS string), 50) AS b")
    exact = {r["column"]: r for r in profiling.column_profile(df).collect()}
    close = {r["column"]: r for r in profiling.column_profile(df, method="sketch").collect()}
    for name, row in exact.items():
        assert (row["nulls"], row["non_nulls"]) == (close[name]["nulls"], close[name]["non_nulls"])
        assert abs(row["distinct"] - close[name]["distinct"]) < 0.03 * row["distinct"]
    assert exact["a"]["distinct"] == 9000 - 9000 // 4
    for line in plan_of(profiling.column_profile(df)).splitlines():
        assert "Exchange hashpartitioning" not in line or "value" not in line
    with pytest.raises(ValueError, match="method"):
        profiling.column_profile(df, method="guess")


def test_value_frequencies(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "a int")
    assert [tuple(r) for r in profiling.value_frequencies(df, ["a"]).collect()] == [("a", "1", 2), ("a", None, 1)]


def test_weighted_rollup_equals_the_row_join(spark):
    ledger_rows = spark.createDataFrame(
        [("a", 1, 5, 1, 10, 1, 4, 1.0, 2), ("a", 1, 5, 1, 20, 1, 8, 2.0, 0), ("b", 1, 5, 1, 5, 1, None, 4.0, 1)],
        "entity_id string, agency int, segment int, period int, capital int, interest int, days_late int, commission_pct double, n_actions int",
    )
    flow = spark.createDataFrame(
        [("a", 1, 5, 1, 100, 7, 30, 3)],
        "entity_id string, agency int, segment int, period int, payment_paid int, days_late_at_close int, balance_at_close int, n_payments_paid int",
    )
    week = rollup.weekly_agency_totals(ledger_rows, flow).first()
    joined = ledger_rows.join(flow, list(rollup.FULL_KEY), "left").agg(
        F.countDistinct("entity_id").alias("n_clients"), F.sum("payment_paid").alias("payment_paid"),
        F.avg("days_late").alias("avg_days_late"), F.avg("days_late_at_close").alias("avg_days_late_at_close"),
        F.avg("balance_at_close").alias("avg_balance"), F.sum("n_payments_paid").alias("n_payments"),
    ).first()
    assert {k: week[k] for k in joined.asDict()} == joined.asDict()


def test_contacts_and_collected_amounts(spark):
    data = [
        ("a", 1, 9, 3, "19.0", "-99.0", "19.0", "-99.0", 0, 120_000),
        ("a", 1, 3, 2, "19.0", "-99.0", "19.0", "-99.0", 0, 120_000),
        ("a", 1, 50, 0, "19.0", "-99.0", "19.0", "-99.0", 0, 120_000),
        ("a", 1, 800, 0, "19.0", "-99.0", "19.0", "-99.0", 0, 120_000),
    ]
    df = spark.createDataFrame(
        data,
        "entity_id string, period int, visit_code int, result_code int, agent_lat string, agent_lon string, "
        "client_lat string, client_lon string, start_ms long, end_ms long",
    )
    assert rows(visits.contacts_by_entity_period(df, code_map(spark), 1), "period") == [("a", 1, 2, 1, 1)]
    assert rows(visits.visit_counts(df, 1), "period") == [("a", 1, 1)]
    paid = spark.createDataFrame([("a", 1, 5, -3), ("a", 1, None, 2)], "entity_id string, period int, capital int, interest int")
    assert rows(visits.collected_by_entity_period(paid), "period") == [("a", 1, 7)]
