"""One query per catalog adapter: the given tables in the sources' layout, adapted back, and its SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.keys import key_parts
from ..sources import catalog
from . import views
from .oracle_views import with_views

# Lies inside the order data, so that start bounds cut.
START = 200003
KEY = ("country", "channel", "branch", "folio")
SEGMENTS = (4, 5)
DAY_MS = 86_400_000

_SNAPSHOT = ("segment", "arrears", "balance", "last_payment", "last_arrears_payment", "n_actions", "n_actions_unpaid")
_LEDGER = ("agency", "segment", "capital", "interest", "auto_charge", "captation", "manager", "days_late", "commission_pct", "n_actions")
_RECOVERIES = ("capital", "interest", "collection_type")
_CASH = (
    "agency", "segment", "payment", "auto_charge_due", "auto_charge", "captation", "arrears", "days_late", "account_class", "days_late_at_payment",
    "portfolio_type", "judicial_flag", "portfolio_origin", "balance", "balance_late", "interest_due", "telephony_flag",
)
_VISITS = ("visit_code", "result_code")


def _in_layout(df: DataFrame, names: Mapping[str, str], **more: Column) -> DataFrame:
    """The frame with the source's column names, as far as it has the columns, and further source columns."""
    return df.select(*[F.col(n).alias(s) for s, n in names.items() if n in df.columns], *[c.alias(s) for s, c in more.items()])


def _parts(year: str, week: str) -> dict[str, Column]:
    return {year: (F.col("period") / 100).cast("int"), week: F.col("period") % 100}


def _with_key(df: DataFrame) -> DataFrame:
    return df.select("*", *key_parts("entity_id", KEY))


def _agency_segments(spark, sf_dir):
    table = _in_layout(views.agency_segments(spark, sf_dir), catalog.AGENCY_SEGMENT)
    return catalog.agency_segments(table, SEGMENTS)


def _agency_master(spark, sf_dir):
    return catalog.agency_master(_in_layout(views.agency_master(spark, sf_dir), catalog.AGENCY_MASTER), {"tax_id": F.upper})


def _snapshot(spark, sf_dir):
    table = _in_layout(views.snapshot(spark, sf_dir), {**catalog.KEY, **catalog.SNAPSHOT})
    return catalog.snapshot(table, START, only=_SNAPSHOT)


def _ledger(spark, sf_dir):
    table = _in_layout(views.ledger(spark, sf_dir), {**catalog.KEY, **catalog.LEDGER}, **_parts("fianio", "fisemana"))
    return catalog.ledger(table, START, only=_LEDGER)


def _recoveries(spark, sf_dir):
    table = _in_layout(views.ledger(spark, sf_dir), {**catalog.CUSTOMER_KEY, **catalog.RECOVERIES}, **_parts("fianioproceso", "fisemproceso"))
    return catalog.recoveries(table, START, only=_RECOVERIES)


def _recoveries_by_own_period(spark, sf_dir):
    own = {"fisemana": F.col("period"), "fideptoid": F.col("segment")}
    table = _in_layout(views.ledger(spark, sf_dir), {**catalog.CUSTOMER_KEY, **catalog.RECOVERIES}, **own)
    return catalog.recoveries_by_own_period(table, SEGMENTS, START, only=("department", *_RECOVERIES))


def _management_results(spark, sf_dir):
    table = _in_layout(_with_key(views.actions(spark, sf_dir)), {**catalog.KEY, **catalog.MANAGEMENT_RESULTS})
    return catalog.management_results(table)


def _visits(spark, sf_dir):
    key = {"fipaiscu": F.col("entity_id"), **{c: F.lit(None).cast("long") for c in ("ficanalcu", "fisucursalcu", "fifoliocu")}}
    table = _in_layout(views.visits(spark, sf_dir), catalog.VISITS, **key)
    return catalog.visits(table).select("entity_id", "period", *_VISITS)


def _cash(spark, sf_dir):
    table = _in_layout(_with_key(views.cash(spark, sf_dir)), {**catalog.KEY, **catalog.CASH}, **_parts("fianio", "fisemana"))
    return catalog.cash_payments(table, START, only=_CASH)


def _segment_changes(spark, sf_dir):
    table = _in_layout(views.segment_changes(spark, sf_dir), {**catalog.KEY, **catalog.SEGMENT_CHANGES})
    return catalog.segment_changes(table)


def _balances(spark, sf_dir):
    return catalog.balances(_in_layout(views.balances(spark, sf_dir), {**catalog.BALANCE_KEY, **catalog.BALANCES}))


def _flat_key_balances(spark, sf_dir):
    return catalog.flat_key_balances(_in_layout(views.flat_balances(spark, sf_dir), catalog.FLAT_KEY_BALANCES))


def _day_calendar(spark, sf_dir):
    return catalog.day_calendar(_in_layout(views.calendar(spark, sf_dir), {"nfecha": "day"}, **_parts("nanioekt", "nsemanaekt")))


def _week_limits(spark, sf_dir):
    limits = views.calendar(spark, sf_dir).groupBy("period").agg(F.min("day").alias("start"), F.max("day").alias("end"))
    ms = {s: (F.datediff(d, F.lit("1970-01-01").cast("date")).cast("long") * DAY_MS) for s, d in (("fcfecinicial", "start"), ("fcfectermino", "end"))}
    return catalog.week_limits(_in_layout(limits, {}, **_parts("fianioproceso", "fisemproceso"), **ms))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "agency_segments": _agency_segments,
    "agency_master": _agency_master,
    "snapshot": _snapshot,
    "ledger": _ledger,
    "recoveries": _recoveries,
    "recoveries_by_own_period": _recoveries_by_own_period,
    "management_results": _management_results,
    "visits": _visits,
    "cash_payments": _cash,
    "segment_changes": _segment_changes,
    "balances": _balances,
    "flat_key_balances": _flat_key_balances,
    "day_calendar": _day_calendar,
    "week_limits": _week_limits,
}

_MONEY = frozenset(
    "balance last_payment last_arrears_payment capital interest auto_charge captation commission_pct payment auto_charge_due balance_late interest_due "
    "total_balance principal_balance".split()
)


def _columns(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" if n in _MONEY else n for n in names)


def statements() -> dict[str, str]:
    key, split = ", ".join(KEY), "entity_id, " + ", ".join(f"CAST(split_part(entity_id, '-', {i + 1}) AS {t}) AS {n}" for i, (n, t) in enumerate(zip(KEY, ("INTEGER", "INTEGER", "BIGINT", "BIGINT"))))
    own_key = "entity_id, " + key
    changes = f"""{key}, concat_ws('-', country, channel, branch, folio) AS entity_id, segment, CAST(record_id % 6 + 1 AS INTEGER) AS new_segment, period,
        CAST(order_total AS DOUBLE) AS balance, CAST(record_id % 7 AS INTEGER) AS arrears, CAST(record_id % 9 AS INTEGER) AS arrears_accumulated"""
    registered = """CASE WHEN record_id % 3 = 0 THEN CAST(opened_at AS DATE)
        ELSE CAST(date_trunc('quarter', opened_at) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) END AS registered_on"""
    master = [n for n in catalog.AGENCY_MASTER.values() if n != "tax_id"]
    selects = {
        "agency_segments": (("v_base",), f"SELECT {_columns(*catalog.AGENCY_SEGMENT.values())} FROM v_base WHERE segment IN {SEGMENTS}"),
        "agency_master": (("v_base",), f"SELECT {_columns(*master)}, upper(tax_id) AS tax_id FROM v_base WHERE segment = 1"),
        "snapshot": (("v_snapshot",), f"SELECT {own_key}, period, {_columns(*_SNAPSHOT)} FROM v_snapshot WHERE period >= {START}"),
        "ledger": (("v_ledger",), f"SELECT {own_key}, period, {_columns(*_LEDGER)} FROM v_ledger WHERE period >= {START}"),
        "recoveries": (("v_ledger",), f"SELECT {own_key}, period, {_columns(*_RECOVERIES)} FROM v_ledger WHERE period >= {START}"),
        "recoveries_by_own_period": (("v_ledger",), f"SELECT {own_key}, period, segment AS department, {_columns(*_RECOVERIES)} FROM v_ledger WHERE period >= {START} AND segment IN {SEGMENTS}"),
        "management_results": (("v_actions",), f"SELECT {split}, yyyymmdd, CAST(action_code AS INTEGER) AS action_code, manager FROM v_actions"),
        "visits": (("v_visits",), f"SELECT entity_id, period, {_columns(*_VISITS)} FROM v_visits"),
        "cash_payments": (("v_cash",), f"SELECT {split}, period, {_columns(*_CASH)} FROM v_cash WHERE period >= {START}"),
        "segment_changes": (("v_orders",), f"SELECT {changes} FROM v_orders"),
        "balances": (("v_orders",), f"SELECT {key}, {registered}, CAST(order_total AS DOUBLE) AS total_balance, CAST(account_balance AS DOUBLE) AS principal_balance, CAST(record_id % 9 AS INTEGER) AS arrears_accumulated FROM v_orders"),
        "flat_key_balances": (("v_orders",), "SELECT entity_id, period, CAST(account_balance AS DOUBLE) AS principal_balance, CAST(record_id % 9 AS INTEGER) AS arrears_accumulated FROM v_orders"),
        "day_calendar": (("v_calendar",), "SELECT day, period FROM v_calendar"),
        "week_limits": (("v_limits",), "SELECT period, start_date, end_date FROM v_limits"),
    }
    return {f"adapter_{name}": with_views(needed, {}, final) for name, (needed, final) in selects.items()}
