"""Views that give the test tables the engine's canonical columns.

Money becomes exact decimals, so sums do not depend on row order. Orders use
``YYYYQQ`` periods, events ISO ``YYYYWW`` periods. The SQL counterparts are in
``oracle_views``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.keys import composite_key
from ..functions.periods import period_from_parts
from ..operators import calendar as cal

DAY_MS = 86_400_000

SNAPSHOT_ORDER = (("opened_at",), ("record_id",))
LEDGER_ORDER = (("managed_at",), ("order_id", "line", "manager", "agency", "price"))
CASH_ORDER = (("paid_at",), ("order_id", "line", "manager", "price"))
EVENT_ORDER = (("opened_at",), ("record_id",))


# Schemas of the given tables: declared, so that no job reads footers to infer them.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quarter_period(day: str) -> Column:
    """``YYYYQQ`` of a date column."""
    return period_from_parts(F.year(day), F.quarter(day))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    branch = (F.col("c_custkey") % 10).alias("branch")
    channel = F.lit(1)
    return joined.select(
        composite_key("c_nationkey", channel, F.col("c_custkey") % 10, "c_custkey").alias("entity_id"),
        F.col("c_nationkey").alias("country"),
        channel.alias("channel"),
        branch,
        F.col("c_custkey").alias("folio"),
        F.col("o_orderkey").alias("record_id"),
        quarter_period("o_orderdate").alias("period"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("segment"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("order_total"),
        F.col("c_acctbal").cast("decimal(15,2)").alias("account_balance"),
        F.col("o_orderdate").alias("opened_at"),
    )


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot records: one per order."""
    o = _orders(spark, sf_dir)
    five_percent = F.col("order_total") * F.lit("0.05").cast("decimal(3,2)")
    n_actions = (F.col("record_id") % 4).cast("int")
    return o.select(
        "entity_id",
        "country",
        "channel",
        "branch",
        "folio",
        "period",
        "segment",
        (F.col("record_id") % 7).cast("int").alias("arrears"),
        F.col("order_total").alias("balance"),
        F.when(F.col("record_id") % 11 != 0, five_percent).alias("last_payment"),
        F.col("account_balance").alias("last_arrears_payment"),
        n_actions.alias("n_actions"),
        F.floor(n_actions / 2).cast("int").alias("n_actions_unpaid"),
        "opened_at",
        "record_id",
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = _orders(spark, sf_dir)
    joined = lines.join(orders, lines.l_orderkey == orders.record_id)
    return joined.withColumns(
        {
            "price": F.col("l_extendedprice").cast("decimal(12,2)"),
            "discount": F.col("l_discount").cast("decimal(3,2)"),
            "tax": F.col("l_tax").cast("decimal(3,2)"),
        }
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows: one per line item; supplier is the agency, part the manager."""
    net = F.col("price") * (F.lit(1) - F.col("discount"))
    return _lines(spark, sf_dir).select(
        "entity_id",
        "country",
        "channel",
        "branch",
        "folio",
        "period",
        "segment",
        F.col("l_suppkey").alias("agency"),
        F.when(F.col("l_returnflag") == "R", -net).otherwise(net).alias("capital"),
        F.when(F.col("l_linenumber") != 7, F.col("price") * F.col("tax")).alias("interest"),
        F.col("l_quantity").cast("decimal(15,2)").alias("auto_charge"),
        (F.col("price") * F.col("discount")).alias("captation"),
        F.col("l_partkey").alias("manager"),
        F.when(F.col("l_linestatus") == "F", "PLAN ACTIVO").otherwise("SIN PLAN").alias("plan"),
        F.ascii("l_returnflag").alias("collection_type"),
        F.col("l_quantity").cast("int").alias("days_late"),
        F.col("discount").alias("commission_pct"),
        (F.col("l_partkey") % 5).cast("int").alias("n_actions"),
        F.col("l_shipdate").alias("managed_at"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        "price",
    )


def cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cash payments with account state: one per line item."""
    return _lines(spark, sf_dir).select(
        "entity_id",
        F.col("l_suppkey").alias("agency"),
        "segment",
        "period",
        F.col("price").alias("payment"),
        (F.col("price") * F.col("tax")).alias("auto_charge_due"),
        F.col("l_quantity").cast("decimal(15,2)").alias("auto_charge"),
        (F.col("price") * F.col("discount")).alias("captation"),
        F.col("l_linenumber").alias("arrears"),
        F.col("l_quantity").cast("int").alias("days_late"),
        F.ascii("l_linestatus").alias("account_class"),
        (F.col("l_partkey") % 90).cast("int").alias("days_late_at_payment"),
        (F.col("l_partkey") % 5).cast("int").alias("portfolio_type"),
        (F.col("l_orderkey") % 2).cast("int").alias("judicial_flag"),
        (F.col("l_orderkey") % 4).cast("int").alias("portfolio_origin"),
        F.col("order_total").alias("balance"),
        (F.col("price") * F.col("discount")).alias("balance_late"),
        (F.col("price") * F.col("tax")).alias("interest_due"),
        (F.col("l_partkey") % 2).cast("int").alias("telephony_flag"),
        F.col("l_shipdate").alias("paid_at"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("manager"),
        "price",
    )


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Management results: one per line item, dated ``YYYYMMDD`` by ship date."""
    return _lines(spark, sf_dir).select(
        "entity_id",
        F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("yyyymmdd"),
        (F.col("l_partkey") % 7 * 50 + 600).cast("int").alias("action_code"),
        F.col("l_suppkey").alias("manager"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
    )


def segment_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment-change events: one per order."""
    return _orders(spark, sf_dir).select(
        "country",
        "channel",
        "branch",
        "folio",
        "segment",
        (F.col("record_id") % 6 + 1).cast("int").alias("new_segment"),
        "period",
        F.col("order_total").alias("balance"),
        (F.col("record_id") % 7).cast("int").alias("arrears"),
        (F.col("record_id") % 9).cast("int").alias("arrears_accumulated"),
    )


def quarter_end(day: str | Column) -> Column:
    """Last day of the quarter of a date."""
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances by registration day; two of three are registered on the closing day."""
    day = F.col("opened_at").cast("date")
    return _orders(spark, sf_dir).select(
        "country",
        "channel",
        "branch",
        "folio",
        F.when(F.col("record_id") % 3 == 0, day).otherwise(quarter_end(day)).alias("registered_on"),
        F.col("order_total").alias("total_balance"),
        F.col("account_balance").alias("principal_balance"),
        (F.col("record_id") % 9).cast("int").alias("arrears_accumulated"),
    )


def flat_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances keyed by the flattened entity key."""
    return _orders(spark, sf_dir).select(
        "entity_id",
        "period",
        F.col("account_balance").alias("principal_balance"),
        (F.col("record_id") % 9).cast("int").alias("arrears_accumulated"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of all quarters that have orders."""
    span = table(spark, sf_dir, "orders").agg(
        F.trunc(F.min("o_orderdate"), "quarter").alias("first_day"),
        quarter_end(F.max("o_orderdate").cast("date")).alias("last_day"),
    )
    return cal.day_calendar(span, quarter_period("day"))


def agency_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier in segments 1 to 5, capacities with zeros."""
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("segment"))
    return rows.select(
        key.alias("agency"),
        "segment",
        (key % 2).cast("int").alias("status"),
        ((key + F.col("segment")) % 50).cast("int").alias("ideal_capacity"),
        (key % 60).cast("int").alias("min_capacity"),
        (key % 90).cast("int").alias("max_capacity"),
        (key % 300).cast("int").alias("current_clients"),
    )


def agency_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master data as deterministic strings of the supplier key, some malformed or missing."""
    key = F.col("s_suppkey")
    text = key.cast("string")
    known = key % 25 != 0

    def digits(n: int, fill: str) -> Column:
        return F.lpad(text, n, fill)

    start = F.lit(1_200_000_000_000) + key * DAY_MS
    return table(spark, sf_dir, "supplier").select(
        key.alias("agency"),
        (key % 4).cast("int").alias("agency_type"),
        (key % 3).cast("int").alias("management_type"),
        (key % 10).cast("int").alias("experience"),
        F.when(known, F.col("s_name")).alias("legal_name"),
        F.when(known, F.when(key % 5 == 1, F.concat(F.lit("AB"), digits(6, "0"))).otherwise(F.concat(F.lit("ABC"), digits(6, "0")))).alias("tax_id"),
        F.when(known, F.when(key % 4 == 1, F.concat(F.lit("mail"), text)).otherwise(F.concat(F.lit(" mail\t"), text, F.lit("@host.com\n")))).alias("email"),
        F.when(known, F.when(key % 7 == 1, "A1").otherwise("A1b")).alias("tax_suffix"),
        (key % 2).cast("int").alias("tax_person_type"),
        F.when(known, F.when(key % 6 == 1, digits(4, "1")).otherwise(digits(5, "0"))).alias("postcode"),
        F.when(known, F.when(key % 3 == 1, digits(9, "5")).otherwise(digits(11, "5"))).alias("phone"),
        F.when(known & (key % 3 != 0), F.concat(F.lit(" Partner "), text)).alias("external_company"),
        F.when(known, start).alias("start_ms"),
        F.when(known & (key % 4 != 0), start + (key % 500) * DAY_MS).alias("end_ms"),
        (key % 2).cast("int").alias("interface_enabled"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("user_id").cast("string").alias("entity_id"),
        "user_id",
        (F.expr("extract(YEAROFWEEK FROM ts)") * 100 + F.weekofyear("ts")).cast("int").alias("period"),
        (F.col("user_id") % 3).cast("int").alias("department"),
        "event_type",
        "value",
        F.col("value").cast("decimal(15,2)").alias("amount"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def event_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot records for the funnels: one per event."""
    return _events(spark, sf_dir).select(
        "entity_id",
        "period",
        "department",
        (F.col("event_id") % 3 + 1).cast("int").alias("segment"),
        (F.col("event_id") % 7).cast("int").alias("arrears"),
        F.when(F.col("event_id") % 11 != 0, F.col("amount")).alias("last_payment"),
        (F.col("k") - 50).cast("decimal(15,2)").alias("last_arrears_payment"),
        F.col("ts").alias("opened_at"),
        F.col("event_id").alias("record_id"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits: one per event, coordinates as text, some missing as ``0.0``."""
    code = F.col("event_type")
    visit_code = F.when(code == "click", 1).when(code == "view", 9).when(code == "error", 11).when(code == "signup", 32)
    latitude = F.lit(19.0) + F.col("user_id").cast("double") / F.lit(1000.0)
    offset = F.col("k").cast("double") / F.lit(100000.0)
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    return _events(spark, sf_dir).select(
        "event_id",
        "entity_id",
        "period",
        visit_code.otherwise(F.col("k") + 780).alias("visit_code"),
        (F.col("k") % 12).alias("result_code"),
        latitude.cast("string").alias("client_lat"),
        F.lit("-99.1").alias("client_lon"),
        F.when(F.col("k") % 17 == 0, "0.0").otherwise((latitude + offset).cast("string")).alias("agent_lat"),
        F.lit("-99.1").alias("agent_lon"),
        start.alias("start_ms"),
        (start + F.round(F.col("value") * 1000).cast("long")).alias("end_ms"),
    )


def event_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments: one per purchase event, interest with negatives and NULLs."""
    return _events(spark, sf_dir).where(F.col("event_type") == "purchase").select(
        "entity_id",
        "period",
        "department",
        F.col("amount").alias("capital"),
        F.when(F.col("k") % 10 != 0, (F.col("k") - 50).cast("decimal(15,2)")).alias("interest"),
    )


def event_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client list of the contact funnel: everyone with an error event."""
    return _events(spark, sf_dir).where(F.col("event_type") == "error").select("entity_id").distinct()
