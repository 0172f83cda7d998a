"""Agency history roll-up: ledger rows with payment flow, week, then agency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FULL_KEY = ("entity_id", "agency", "segment", "period")


def _quotient(numerator: Column, denominator: Column) -> Column:
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def weekly_agency_totals(ledger: DataFrame, flow: DataFrame) -> DataFrame:
    """Totals and means per (agency, segment, period) over ledger rows.

    ``flow`` has one row per full key and belongs to every ledger row of that
    key. The ledger is summed to the full key before the join; flow values are
    then weighted by the number of ledger rows, which gives the same sums and
    means as joining row by row.
    """
    by_key = ledger.groupBy(*FULL_KEY).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("capital").alias("capital"),
        F.sum("interest").alias("interest"),
        F.sum("days_late").alias("days_late_sum"),
        F.count("days_late").alias("days_late_n"),
        F.sum("commission_pct").alias("commission_sum"),
        F.count("commission_pct").alias("commission_n"),
        F.sum("n_actions").alias("n_actions"),
    )
    joined = by_key.join(
        flow.select(*FULL_KEY, "payment_paid", "days_late_at_close", "balance_at_close", "n_payments_paid"),
        on=list(FULL_KEY),
        how="left",
    )

    def weighted(name: str) -> Column:
        return F.sum(F.col(name) * F.col("n_rows"))

    def weighted_mean(name: str) -> Column:
        return _quotient(weighted(name), F.sum(F.when(F.col(name).isNotNull(), F.col("n_rows"))))

    return joined.groupBy("agency", "segment", "period").agg(
        # one row per full key, so rows are distinct entities
        F.count("entity_id").alias("n_clients"),
        F.sum("capital").alias("capital"),
        F.sum("interest").alias("interest"),
        weighted("payment_paid").alias("payment_paid"),
        _quotient(F.sum("days_late_sum"), F.sum("days_late_n")).alias("avg_days_late"),
        weighted_mean("days_late_at_close").alias("avg_days_late_at_close"),
        _quotient(F.sum("commission_sum"), F.sum("commission_n")).alias("avg_commission"),
        weighted_mean("balance_at_close").alias("avg_balance"),
        F.sum("n_actions").alias("n_actions"),
        weighted("n_payments_paid").alias("n_payments"),
    )


def agency_rollup(weekly: DataFrame) -> DataFrame:
    """Means, peaks, totals and volatility over the weeks of (agency, segment)."""

    def mean(name: str) -> Column:
        return _quotient(F.sum(name), F.count(name))

    return weekly.groupBy("agency", "segment").agg(
        mean("n_clients").alias("avg_clients"),
        F.max("n_clients").alias("max_clients"),
        mean("capital").alias("avg_capital"),
        F.sum("capital").alias("total_capital"),
        mean("payment_paid").alias("avg_payment_paid"),
        _quotient(F.sum("capital"), F.sum("n_actions")).alias("capital_per_action"),
        mean("avg_days_late").alias("avg_days_late"),
        F.max("avg_days_late").alias("worst_week_days_late"),
        mean("n_actions").alias("avg_actions"),
        mean("n_payments").alias("avg_payments"),
        F.stddev(F.col("capital").cast("double")).alias("capital_volatility"),
        mean("avg_commission").alias("avg_commission"),
    )
