"""Registered queries: every operator and pipeline over the given tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from ..functions.keys import composite_key
from ..functions.periods import epoch_ms_to_date, period_from_parts
from ..operators import calendar, cohort, latest, ledger, population, profiling, quality, quantile, ratios, transitions, trend, visits
from ..operators.score import agency_score
from ..plans.batch import Inputs, run_batch
from ..plans.check import CHECKED_COLUMNS
from ..plans.cohort import entry_cohort
from ..plans.dataset import agency_base, agency_dataset, agency_features, agency_profile
from ..plans.funnels import contact_funnel, period_funnel
from ..plans.history import history_base
from ..plans.rollup import agency_history_rollup
from ..sources.codes import code_map
from ..sources.sinks import export_csv, save_table
from . import adapters, views

# The whole span of the order data: one look-back period, then all others.
LOOK_BACK, FIRST, PIVOT = 199501, 199502, 200103
# The last of the earlier run's periods, and the first that the update brings.
KNOWN, ADDED = 200004, 200101
ENTRY, ENTRY_END = 200003, 200103
LEGAL = (4, 5)
ALL_SEGMENTS = (1, 2, 3, 4, 5)
AS_OF_MS = 1_700_000_000_000
N_PERIODS = 26
FUNNEL_ENTRY, FUNNEL_FIRST, FUNNEL_LAST = 202402, 202399, 202405
# Bounds inside the event data.
BOUNDED_FIRST, BOUNDED_LAST = 202403, 202404
COUNTRY = 10
DEPARTMENTS = (0, 1, 2)
SLOPE_DIGITS = 9

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _publish(df: DataFrame) -> DataFrame:
    """Decimals as doubles: one numeric type for every reader."""
    money = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in money})


def _query(build: Query) -> Query:
    _QUERIES[build.__name__.removesuffix("_query")] = lambda spark, sf_dir: _publish(build(spark, sf_dir))
    return build


def registered() -> dict[str, Query]:
    """All queries by name."""
    adapted = {f"adapter_{name}": (lambda spark, sf_dir, build=build: _publish(build(spark, sf_dir))) for name, build in adapters.QUERIES.items()}
    return _QUERIES | adapted


# --- keys, periods, last record -------------------------------------------------------


@_query
def composite_key_query(spark, sf_dir):
    customers = views.table(spark, sf_dir, "customer")
    return customers.select(
        "c_custkey",
        composite_key("c_nationkey", F.lit(1), F.col("c_custkey") % 10, "c_custkey").alias("entity_id"),
        composite_key(F.nullif(F.col("c_nationkey"), F.lit(3)), F.lit(1), F.col("c_custkey") % 10, "c_custkey").alias("gap_key"),
    )


@_query
def period_from_parts_query(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", period_from_parts(F.year("o_orderdate"), F.month("o_orderdate")).alias("period"))


@_query
def period_around_query(spark, sf_dir):
    days = views.calendar(spark, sf_dir)

    def found(name, *args):
        return calendar.period_around(days, *args).select(F.lit(name).alias("lookup"), "period")

    return (
        found("11 back", PIVOT, 11)
        .unionByName(found("3 forward", LOOK_BACK, 3, True))
        .unionByName(found("too far back", FIRST, 40))
        .unionByName(found("none", LOOK_BACK, 1))
    )


@_query
def period_limits_query(spark, sf_dir):
    return calendar.period_limits(views.calendar(spark, sf_dir))


@_query
def period_of_date_query(spark, sf_dir):
    limits = calendar.period_limits(views.calendar(spark, sf_dir))
    dated = calendar.with_period_of_date(views.actions(spark, sf_dir), limits, "yyyymmdd")
    return dated.select("order_id", "line", "yyyymmdd", "period")


def _last_snapshot(spark, sf_dir):
    return latest.latest_per_key(views.snapshot(spark, sf_dir), ("entity_id", "period"), *views.SNAPSHOT_ORDER)


@_query
def snapshot_last_record(spark, sf_dir):
    return _last_snapshot(spark, sf_dir).select("entity_id", "period", "segment", "arrears", "balance", "record_id")


@_query
def ledger_last_record(spark, sf_dir):
    rows = latest.latest_per_key(views.ledger(spark, sf_dir), ("entity_id", "period"), *views.LEDGER_ORDER)
    return ledger.with_plan_flag(rows).select("entity_id", "period", "agency", "plan_active")


@_query
def entity_population(spark, sf_dir):
    return population.entity_population(views.snapshot(spark, sf_dir), LOOK_BACK, LEGAL)


# --- ledger and transitions -----------------------------------------------------------


@_query
def ledger_entity_period(spark, sf_dir):
    return ledger.ledger_by_entity_period(views.ledger(spark, sf_dir), *views.LEDGER_ORDER)


@_query
def multi_channel_flag(spark, sf_dir):
    return ledger.multi_channel_flag(views.ledger(spark, sf_dir))


@_query
def managed_actions(spark, sf_dir):
    limits = calendar.period_limits(views.calendar(spark, sf_dir))
    return ledger.actions_by_entity_period(calendar.with_period_of_date(views.actions(spark, sf_dir), limits, "yyyymmdd"))


@_query
def managed_actions_from(spark, sf_dir):
    days = views.calendar(spark, sf_dir)
    recent = calendar.dated_from(views.actions(spark, sf_dir), days, ENTRY, "yyyymmdd")
    return ledger.actions_by_entity_period(calendar.with_period_of_date(recent, calendar.period_limits(days), "yyyymmdd"))


@_query
def period_lookup(spark, sf_dir):
    return calendar.period_limits_of(views.calendar(spark, sf_dir), ENTRY)


@_query
def payments_by_period(spark, sf_dir):
    return ledger.payments_by_period(views.ledger(spark, sf_dir), LOOK_BACK, PIVOT)


@_query
def payments_cumulative(spark, sf_dir):
    return ledger.with_cumulative_payment(ledger.payments_by_period(views.ledger(spark, sf_dir), LOOK_BACK, PIVOT))


@_query
def payment_flow_and_close(spark, sf_dir):
    return ledger.payment_flow_and_close(views.cash(spark, sf_dir), *views.CASH_ORDER, start_period=LOOK_BACK)


@_query
def required_payment(spark, sf_dir):
    rows = transitions.with_required_payment(_last_snapshot(spark, sf_dir))
    return rows.select("entity_id", "period", "required_payment")


@_query
def required_payment_clamped(spark, sf_dir):
    rows = transitions.with_required_payment(_last_snapshot(spark, sf_dir), clamped=True)
    return rows.select("entity_id", "period", "required_payment")


@_query
def arrears_roll(spark, sf_dir):
    rows = transitions.with_arrears_roll(_last_snapshot(spark, sf_dir))
    return rows.select(
        "entity_id", "period", "arrears", "prev_arrears", "next_arrears",
        "roll_forward", "roll_backward", "with_prev_arrears", "with_next_arrears",
    )


@_query
def segment_transitions(spark, sf_dir):
    rows = transitions.with_segment_transitions(_last_snapshot(spark, sf_dir), LEGAL)
    return rows.select(
        "entity_id", "period", "segment", "prev_segment", "next_segment",
        "enter_legal", "out_legal", "in_legal", "with_prev_segment", "with_next_segment",
    )


@_query
def ledger_of_population(spark, sf_dir):
    """The population's ledger rows, with the filter that goes before the exchange."""
    members = population.entity_population(views.snapshot(spark, sf_dir), PIVOT - 1, LEGAL)
    own = population.restrict_to(views.ledger(spark, sf_dir), members, prefilter_bits=1 << 20)
    return own.select("entity_id", "period", "agency", "manager", "capital")


# --- history and ratios ---------------------------------------------------------------


def _history(spark, sf_dir):
    base = history_base(
        views.snapshot(spark, sf_dir), views.ledger(spark, sf_dir), LOOK_BACK, LEGAL, views.SNAPSHOT_ORDER, views.LEDGER_ORDER
    )
    return base.where(F.col("period").between(FIRST, PIVOT))


def _legal_history(spark, sf_dir):
    return _history(spark, sf_dir).where(F.col("segment").isin(list(LEGAL)))


@_query
def history_base_query(spark, sf_dir):
    return _history(spark, sf_dir)


@_query
def agency_ratios(spark, sf_dir):
    return ratios.agency_ratios(_legal_history(spark, sf_dir))


@_query
def agency_ratios_by_period(spark, sf_dir):
    return ratios.agency_ratios(_legal_history(spark, sf_dir), by_period=True)


@_query
def ratio_categories(spark, sf_dir):
    labelled = ratios.with_ratio_categories(ratios.agency_ratios(_legal_history(spark, sf_dir)))
    return labelled.select("agency", "segment", "cat_efficiency", "cat_management_intensity", "cat_effective_management")


def _slopes(spark, sf_dir):
    return trend.trend_slopes(ratios.agency_ratios(_legal_history(spark, sf_dir), by_period=True))


@_query
def trend_slopes(spark, sf_dir):
    slopes = _slopes(spark, sf_dir)
    measured = [c for c in slopes.columns if c.startswith(("slope_", "std_"))]
    return slopes.withColumns({c: F.round(c, SLOPE_DIGITS) for c in measured})


@_query
def trend_labels(spark, sf_dir):
    labels = trend.trend_labels(_slopes(spark, sf_dir))
    return labels.drop("trend_score", "trend_profile")


@_query
def trend_profile(spark, sf_dir):
    labels = trend.trend_labels(_slopes(spark, sf_dir))
    return labels.select("agency", "segment", "trend_score", "trend_profile")


def _features(spark, sf_dir):
    return agency_features(_history(spark, sf_dir), LEGAL, N_PERIODS)


@_query
def agency_features_query(spark, sf_dir):
    return _features(spark, sf_dir)


@_query
def agency_score_query(spark, sf_dir):
    return _scored(spark, sf_dir, "window")


@_query
def agency_score_split(spark, sf_dir):
    return _scored(spark, sf_dir, "split")


def _scored(spark, sf_dir, method):
    features = _features(spark, sf_dir)
    if method != "split":
        return _rounded(agency_score(features, method=method))
    name = _own_name(spark, "score")

    def keep(df, part):
        save_table(df, f"{name}_{part}")
        return spark.table(f"{name}_{part}")

    # the split method reads its input several times
    return _rounded(agency_score(keep(features, "features"), method=method, store=keep))


def _rounded(scored):
    percentiles = [c for c in scored.columns if c.startswith("score_")]
    return scored.select("agency", "segment", *[F.round(c, SLOPE_DIGITS).alias(c) for c in percentiles], "rank", "band")


# --- agency master data ---------------------------------------------------------------


def _base(spark, sf_dir):
    return agency_base(views.agency_segments(spark, sf_dir), views.agency_master(spark, sf_dir), ALL_SEGMENTS)


@_query
def agency_base_query(spark, sf_dir):
    return _base(spark, sf_dir)


@_query
def null_fill(spark, sf_dir):
    filled = quality.fill_missing(_base(spark, sf_dir), {"external_company": ""})
    return filled.select("agency", "segment", "external_company")


@_query
def sparse_row_drop(spark, sf_dir):
    return quality.drop_sparse_rows(_base(spark, sf_dir)).select("agency", "segment")


@_query
def status_date_repair(spark, sf_dir):
    return quality.repair_status_dates(_base(spark, sf_dir), AS_OF_MS).select("agency", "segment", "status", "end_ms")


@_query
def outlier_null(spark, sf_dir):
    return quality.null_outliers(_base(spark, sf_dir)).select("agency", "segment", *quality.CAPACITIES)


@_query
def median_impute(spark, sf_dir):
    cleaned = quality.null_outliers(_base(spark, sf_dir))
    return quality.impute_group_medians(cleaned).select("agency", "segment", *quality.CAPACITIES)


@_query
def median_impute_exact(spark, sf_dir):
    cleaned = quality.null_outliers(_base(spark, sf_dir), method="exact")
    return quality.impute_group_medians(cleaned, method="exact").select("agency", "segment", *quality.CAPACITIES)


@_query
def balance_quantiles(spark, sf_dir):
    """Exact medians and outlier cuts of every account's balance by segment; far more values than a sketch holds exactly."""
    records = views.snapshot(spark, sf_dir)
    cuts = [quantile.exact_quantiles(records, ["balance"], q, "segment").select(F.col("_group").alias("segment"), F.lit(q).alias("quantile"), "balance") for q in (0.5, quality.OUTLIER_QUANTILE)]
    return cuts[0].unionByName(cuts[1])


@_query
def capacity_bounds(spark, sf_dir):
    return quality.enforce_capacity_bounds(_base(spark, sf_dir)).select("agency", "segment", *quality.CAPACITIES)


@_query
def capacity_ratios(spark, sf_dir):
    rows = quality.with_capacity_ratios(_base(spark, sf_dir))
    return rows.select(
        "agency", "segment", "min_over_ideal_capacity", "min_over_max_capacity",
        "capacity_range", "range_over_ideal_capacity", "range_over_max_capacity",
    )


@_query
def field_validity(spark, sf_dir):
    rows = quality.with_field_validity(_base(spark, sf_dir))
    return rows.select("agency", "segment", *[c for c in rows.columns if c.startswith(("valid_", "has_"))])


@_query
def tenure_days(spark, sf_dir):
    base = quality.repair_status_dates(_base(spark, sf_dir), AS_OF_MS)
    started = base.withColumn("start_date", epoch_ms_to_date("start_ms"))
    return quality.with_tenure(started).select("agency", "segment", "start_date", "seniority_days")


def _profile(spark, sf_dir):
    return agency_profile(_base(spark, sf_dir), AS_OF_MS)


@_query
def agency_profile_query(spark, sf_dir):
    return _profile(spark, sf_dir)


@_query
def agency_dataset_query(spark, sf_dir):
    return agency_dataset(_profile(spark, sf_dir), _features(spark, sf_dir))


@_query
def value_frequencies(spark, sf_dir):
    return profiling.value_frequencies(_base(spark, sf_dir), CHECKED_COLUMNS)


@_query
def column_profile(spark, sf_dir):
    return profiling.column_profile(views.snapshot(spark, sf_dir))


@_query
def row_and_key_totals(spark, sf_dir):
    return profiling.row_and_key_totals(views.ledger(spark, sf_dir))


# --- sinks and the batch run: written, then read back ---------------------------------


def _own_name(spark, name):
    """A table name that no other application's tables have, which may lie in the same warehouse."""
    return f"agencylens_{name}_{re.sub('[^0-9a-zA-Z]', '_', spark.sparkContext.applicationId)}"


def _inputs(spark, sf_dir):
    return Inputs(
        views.calendar(spark, sf_dir),
        views.snapshot(spark, sf_dir),
        views.ledger(spark, sf_dir),
        views.agency_segments(spark, sf_dir),
        views.agency_master(spark, sf_dir),
        views.SNAPSHOT_ORDER,
        views.LEDGER_ORDER,
    )


def _batch(spark, sf_dir, **scoring):
    """Run the batch over all periods and return its table's name."""
    inputs = _inputs(spark, sf_dir)
    name = _own_name(spark, "batch")
    run_batch(inputs, PIVOT, LEGAL, AS_OF_MS, name, N_PERIODS, f"{name}_scored", **scoring)
    return name


@_query
def batch_run(spark, sf_dir):
    return spark.table(_batch(spark, sf_dir))


@_query
def batch_run_history(spark, sf_dir):
    return spark.table(f"{_batch(spark, sf_dir)}_history")


@_query
def batch_update_history(spark, sf_dir):
    """A run before the last three periods were known, then one that brings its history up to date."""
    inputs = _inputs(spark, sf_dir)
    before = lambda df: df.where(F.col("period") < ADDED)
    name = _own_name(spark, "updated")
    earlier = replace(inputs, snapshot=before(inputs.snapshot), ledger=before(inputs.ledger))
    run_batch(earlier, KNOWN, LEGAL, AS_OF_MS, name, N_PERIODS - 3)
    run_batch(inputs, PIVOT, LEGAL, AS_OF_MS, name, N_PERIODS, changed_from=ADDED)
    return spark.table(f"{name}_history")


@_query
def batch_run_scored(spark, sf_dir):
    return _rounded(spark.table(f"{_batch(spark, sf_dir, method='split')}_scored"))


@_query
def table_sink(spark, sf_dir):
    """Saved by period, one period saved again: the others stay."""
    paid = ledger.payments_by_period(views.ledger(spark, sf_dir), LOOK_BACK, PIVOT)
    name = _own_name(spark, "payments")
    save_table(paid, name, partition_by=("period",))
    save_table(paid.where(F.col("period") == PIVOT), name, ("period",), keep_other_partitions=True)
    return spark.table(name)


@_query
def csv_sink(spark, sf_dir):
    paid = ledger.payments_by_period(views.ledger(spark, sf_dir), LOOK_BACK, PIVOT)
    path = f"{spark.conf.get('spark.sql.warehouse.dir')}/{_own_name(spark, 'payments')}_csv"
    export_csv(paid, path)
    return spark.read.schema(paid.schema).csv(path, header=True)


# --- visits and funnels ---------------------------------------------------------------


@_query
def contact_type(spark, sf_dir):
    typed = visits.with_contact_flags(visits.with_contact_type(views.visits(spark, sf_dir), code_map(spark)))
    return typed.select("event_id", "visit_code", "result_code", "contact_type", "direct_contact", "effective_contact")


@_query
def visit_geo_valid(spark, sf_dir):
    return visits.valid_on_site(views.visits(spark, sf_dir)).select(
        "event_id", "minutes", F.round("dist_m", 0).alias("dist_m")
    )


@_query
def visit_counts(spark, sf_dir):
    return visits.visit_counts(views.visits(spark, sf_dir), FUNNEL_FIRST)


@_query
def contacts_by_entity_period(spark, sf_dir):
    return visits.contacts_by_entity_period(views.visits(spark, sf_dir), code_map(spark), 1)


@_query
def collected_by_entity_period(spark, sf_dir):
    return visits.collected_by_entity_period(views.event_payments(spark, sf_dir))


@_query
def entry_population(spark, sf_dir):
    return population.entry_population(views.event_snapshot(spark, sf_dir), FUNNEL_ENTRY, DEPARTMENTS)


@_query
def period_funnel_query(spark, sf_dir):
    return period_funnel(
        views.event_snapshot(spark, sf_dir), views.visits(spark, sf_dir), views.event_payments(spark, sf_dir), code_map(spark),
        "phase", FUNNEL_ENTRY, DEPARTMENTS, FUNNEL_LAST, FUNNEL_FIRST, *views.EVENT_ORDER,
    )


@_query
def period_funnel_bounded(spark, sf_dir):
    return period_funnel(
        views.event_snapshot(spark, sf_dir), views.visits(spark, sf_dir), views.event_payments(spark, sf_dir), code_map(spark),
        "phase", FUNNEL_ENTRY, DEPARTMENTS, BOUNDED_LAST, BOUNDED_FIRST - 2, *views.EVENT_ORDER,
    )


def _bounded_contacts(spark, sf_dir, **side):
    return contact_funnel(
        views.event_snapshot(spark, sf_dir), views.visits(spark, sf_dir), views.event_payments(spark, sf_dir), code_map(spark),
        views.event_clients(spark, sf_dir), BOUNDED_FIRST, BOUNDED_LAST, look_back=BOUNDED_FIRST - 1,
        order_by=views.EVENT_ORDER[0], tie_break=views.EVENT_ORDER[1], **side,
    )


@_query
def contact_funnel_current(spark, sf_dir):
    return _bounded_contacts(spark, sf_dir, only_current=True)


@_query
def contact_funnel_non_current(spark, sf_dir):
    return _bounded_contacts(spark, sf_dir, only_non_current=True)


@_query
def contact_funnel_query(spark, sf_dir):
    return contact_funnel(
        views.event_snapshot(spark, sf_dir), views.visits(spark, sf_dir), views.event_payments(spark, sf_dir), code_map(spark),
        views.event_clients(spark, sf_dir), FUNNEL_FIRST + 2, FUNNEL_LAST,
        order_by=views.EVENT_ORDER[0], tie_break=views.EVENT_ORDER[1],
    )


# --- cohort and roll-up ---------------------------------------------------------------


def _entries(spark, sf_dir):
    return cohort.entries_from_snapshots(views.snapshot(spark, sf_dir), ENTRY, *views.SNAPSHOT_ORDER, country=None)


@_query
def cohort_entry_from_snapshots(spark, sf_dir):
    return _entries(spark, sf_dir)


@_query
def cohort_entry_in_country(spark, sf_dir):
    return cohort.entries_from_snapshots(views.snapshot(spark, sf_dir), ENTRY, *views.SNAPSHOT_ORDER, country=COUNTRY)


@_query
def cohort_entry_events(spark, sf_dir):
    return cohort.entries_from_events(views.segment_changes(spark, sf_dir), ENTRY)


@_query
def cohort_arrears(spark, sf_dir):
    return cohort.cohort_arrears(views.snapshot(spark, sf_dir), LOOK_BACK, PIVOT, *views.SNAPSHOT_ORDER)


def _closing_balances(spark, sf_dir, first=LOOK_BACK, last=PIVOT):
    return cohort.balance_at_close(views.balances(spark, sf_dir), views.calendar(spark, sf_dir), first, last)


@_query
def balance_at_close(spark, sf_dir):
    return _closing_balances(spark, sf_dir)


@_query
def balance_split_key(spark, sf_dir):
    return cohort.balance_with_split_key(views.flat_balances(spark, sf_dir), LOOK_BACK, PIVOT)


@_query
def cohort_followup(spark, sf_dir):
    return entry_cohort(
        views.snapshot(spark, sf_dir), _entries(spark, sf_dir), views.ledger(spark, sf_dir), _closing_balances(spark, sf_dir, ENTRY, ENTRY_END),
        ENTRY, ENTRY_END, *views.SNAPSHOT_ORDER,
    )


@_query
def agency_history_rollup_query(spark, sf_dir):
    return _rolled(spark, sf_dir, LOOK_BACK)


@_query
def agency_history_rollup_from(spark, sf_dir):
    return _rolled(spark, sf_dir, ENTRY)


def _rolled(spark, sf_dir, start_period):
    rolled = agency_history_rollup(views.ledger(spark, sf_dir), views.cash(spark, sf_dir), start_period, *views.CASH_ORDER)
    # only these add up doubles, in whatever order rows arrive
    digits = {"avg_days_late": 6, "avg_commission": 9, "capital_volatility": 2}
    return rolled.withColumns({c: F.round(c, d) for c, d in digits.items()})
