"""Column functions on hand-checked values."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from agencylens.functions import amounts, geo, keys, labels, periods, stats, validity


def one(spark, values, schema, *columns):
    return tuple(spark.createDataFrame([values], schema).select(*columns).first())


def test_key_skips_missing_parts(spark):
    schema = "a int, b int, c int, d int"
    key = keys.composite_key("a", "b", "c", "d")
    assert one(spark, (None, 7, None, 9), schema, key) == ("7-9",)
    assert one(spark, (None,) * 4, schema, key) == ("",)
    assert one(spark, (1, 2, 3, 4), schema, key) == ("1-2-3-4",)
    strict = keys.composite_key("a", "b", "c", "d", require_all_parts=True)
    assert one(spark, (None, 7, None, 9), schema, strict) == (None,)


def test_key_splits_into_typed_parts(spark):
    assert one(spark, ("1-2-30-400",), "k string", *keys.key_parts("k")) == (1, 2, 30, 400)
    assert one(spark, ("1-x",), "k string", *keys.key_parts("k")) == (1, None, None, None)
    types = [f.dataType.simpleString() for f in spark.createDataFrame([("1-2-3-4",)], "k string").select(*keys.key_parts("k")).schema]
    assert types == ["int", "int", "bigint", "bigint"]


@pytest.mark.parametrize(("year", "week", "period"), [(2026, 3, 202603), (2026, 12, 202612), (2026, 103, 202610)])
def test_period_pads_and_cuts_the_week(spark, year, week, period):
    assert one(spark, (year, week), "y int, w int", periods.period_from_parts("y", "w")) == (period,)


def test_dates(spark):
    assert one(spark, (0,), "ms bigint", periods.epoch_ms_to_date("ms")) == (datetime.date(1970, 1, 1),)
    assert one(spark, (20240229,), "d int", periods.int_to_date("d")) == (datetime.date(2024, 2, 29),)
    assert one(spark, (20240231,), "d int", periods.int_to_date("d")) == (None,)


def test_tenure_is_zero_without_both_ends(spark):
    day = 86_400_000
    tenure = periods.tenure_days("s", "e")
    assert one(spark, (0, 10 * day), "s bigint, e bigint", tenure) == (10,)
    assert one(spark, (0, None), "s bigint, e bigint", tenure) == (0,)


def test_period_distance_uses_52_weeks(spark):
    distance = periods.period_distance("p", "o")
    assert one(spark, (202602, 202551), "p int, o int", distance) == (3,)


@pytest.mark.parametrize(("a", "b", "expected"), [(5, -2, 3), (1, -4, 0), (3, None, 0)])
def test_positive_sum(spark, a, b, expected):
    assert one(spark, (a, b), "a int, b int", amounts.positive_sum("a", "b")) == (expected,)


def test_clamp_and_fill(spark):
    assert one(spark, (-3, None), "a int, b int", amounts.clamp_at_zero("a"), amounts.clamp_at_zero("b")) == (0, 0)
    assert one(spark, (-3, None), "a int, b int", amounts.filled_sum("a", "b")) == (-3,)


def test_guarded_ratios(spark):
    schema = "n int, d int"
    assert one(spark, (1, 4), schema, amounts.ratio_or_null("n", "d"), amounts.ratio_or_zero("n", "d")) == (0.25, 0.25)
    for bad in (0, -1, None):
        assert one(spark, (1, bad), schema, amounts.ratio_or_null("n", "d"), amounts.ratio_or_zero("n", "d")) == (None, 0.0)


@pytest.mark.parametrize(
    ("value", "expected"), [("ABC123456", 1), ("ÑBC123456", 1), ("ñbc123456", 0), ("AB12345", 0), (" abc123456\n", 1), (None, 0)]
)
def test_tax_id(spark, value, expected):
    assert one(spark, (value,), "v string", validity.pattern_valid("v", validity.TAX_ID_PATTERN)) == (expected,)


@pytest.mark.parametrize(("value", "expected"), [("12345", 1), ("12345\n", 1), ("1234", 0), ("123456", 0), (None, 0)])
def test_postcode(spark, value, expected):
    assert one(spark, (value,), "v string", validity.digits_valid("v", 5, 5)) == (expected,)


def test_text_presence(spark):
    for value, expected in ((" abcdef ", 1), ("abcde", 0), ("123456", 0), (None, 0)):
        assert one(spark, (value,), "v string", validity.text_present("v")) == (expected,)


def test_distance_of_identical_points(spark):
    rows = [(f"{19 + i / 997}", f"{-99 - i / 499}") for i in range(480)]
    df = spark.createDataFrame(rows, "lat string, lon string")
    clamped = df.select(geo.great_circle_m("lat", "lon", "lat", "lon").alias("d"))
    assert clamped.where("isnan(d) OR d > 0.2").count() == 0
    raw = df.select(geo.great_circle_m("lat", "lon", "lat", "lon", clamp=False).alias("d"))
    assert raw.where("isnan(d)").count() > 0


def test_distance_value(spark):
    schema = "a string, b string, c string, d string"
    (metres,) = one(spark, ("0", "0", "0", "1"), schema, geo.great_circle_m("a", "b", "c", "d"))
    assert metres == pytest.approx(math.radians(1) * 6_371_000, abs=0.01)
    assert one(spark, ("x", "0", "0", "1"), schema, geo.great_circle_m("a", "b", "c", "d")) == (None,)


def test_slope_with_gap(spark):
    series = spark.createDataFrame([(1, 2.0), (2, None), (3, 6.0), (4, 8.0)], "t int, y double")
    both = series.agg(stats.ols_slope("y"), stats.ols_slope("y", null_handling="pairwise")).first()
    assert both[0] == pytest.approx(0.4)
    assert both[1] == pytest.approx(2.0)
    assert series.where("t = 1").agg(stats.ols_slope("y")).first()[0] is None
    with pytest.raises(ValueError):
        stats.ols_slope("y", null_handling="other")


def test_bands(spark):
    cases = [(80.0, "Élite"), (60.0, "Buen desempeño"), (40.0, "Desempeño medio"), (20.0, "Bajo desempeño"), (19.9, "Crítico")]
    for score, band in cases:
        assert one(spark, (score,), "s double", labels.score_band_label(F.col("s"))) == (band,)


def test_missing_values_in_labels(spark):
    empty = F.lit(None).cast("double")
    row = spark.range(1).select(
        labels.efficiency_label(empty),
        labels.share_label(empty),
        labels.tercile_label(empty, empty, empty),
        labels.stability_label(empty, F.lit(1.0)),
        labels.with_enough_periods(F.lit(1), F.lit("Estable")),
    )
    assert tuple(row.first()) == ("Sin datos", "Gestión escasa", "Sin datos", "Sin datos", "Insuficiente")
