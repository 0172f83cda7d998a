"""Adapters from catalog tables to canonical columns.

Each adapter takes the table as a DataFrame (``spark.table(name)``,
``spark.read.parquet(path)``), keeps only the columns the engine uses and gives
them canonical names, so column pruning and filters reach the scan. A column
that the source lacks is an error; ``only`` names the canonical columns to take
from a source that has fewer (the key and the period always come along).

``decoders`` maps a canonical column to a function from ``Column`` to
``Column`` for fields stored encoded (tax id, e-mail, coordinates); identity by
default.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import composite_key
from ..functions.periods import epoch_ms_to_date, period_from_parts

Decoders = Mapping[str, Callable[[Column], Column]]

# Column names of the source tables.
KEY = {"fipais": "country", "ficanal": "channel", "fisucursal": "branch", "fifolio": "folio"}
CUSTOMER_KEY = {"fipaiscu": "country", "ficanalcu": "channel", "fisucursalcu": "branch", "fifoliocu": "folio"}
BALANCE_KEY = {
    "clienteunicopais": "country",
    "clienteunicocanal": "channel",
    "clienteunicosucursal": "branch",
    "clienteunicofolio": "folio",
}
AGENCY_SEGMENT = {
    "fidespid": "agency",
    "fitipodepto": "segment",
    "estatus": "status",
    "fncapacidadideal": "ideal_capacity",
    "fncapacidadmin": "min_capacity",
    "fncapacidadmax": "max_capacity",
    "fnclientesactual": "current_clients",
}
AGENCY_MASTER = {
    "fidespid": "agency",
    "fntipodespacho": "agency_type",
    "fitipogestion": "management_type",
    "fitiempomanejocobza": "experience",
    "fcnombrerazonsocial": "legal_name",
    "fcrfc": "tax_id",
    "fcemail1": "email",
    "fchomoclave": "tax_suffix",
    "fiidtipopersfiscal": "tax_person_type",
    "fccodpostal": "postcode",
    "fctelefono1": "phone",
    "fcempresascobext": "external_company",
    "fdfechaalta": "start_ms",
    "fdfechabaja": "end_ms",
    "fihabilitadointerf": "interface_enabled",
}
SNAPSHOT = {
    "fisemana": "period",
    "fitipodepto": "segment",
    "fideptoid": "department",
    "fisematrasomax": "arrears",
    "fnsaldocte": "balance",
    "fnultimoabono": "last_payment",
    "fnultabonomora": "last_arrears_payment",
    "fdfechasurtimiento": "opened_at",
    "fdfechaultimaact": "updated_at",
    "finogestiones": "n_actions",
    "finogestsincobro": "n_actions_unpaid",
}
LEDGER = {
    "fidespid": "agency",
    "fitipodepto": "segment",
    "fnrecupcapital": "capital",
    "fnrecupmoratorios": "interest",
    "fnmontocargoautomatico": "auto_charge",
    "fnmontocaptacion": "captation",
    "figestor": "manager",
    "fcplan": "plan",
    "fdfechagestion": "managed_at",
    "fidiasatraso": "days_late",
    "fiporcentajecomision": "commission_pct",
    "n_gestiones": "n_actions",
}
RECOVERIES = {
    "fideptoid": "department",
    "fdcreccapital": "capital",
    "fdcrecmoratorio": "interest",
    "fitipocobranza": "collection_type",
}
MANAGEMENT_RESULTS = {"fifecha": "yyyymmdd", "fiaccionges": "action_code", "figestor": "manager"}
VISITS = {
    "fisemana": "period",
    "fivisitaid": "visit_code",
    "figestionid": "result_code",
    "fclatitudcliente": "client_lat",
    "fclongitudcliente": "client_lon",
    "fclatitudgps": "agent_lat",
    "fclongitudgps": "agent_lon",
    "fdfeciniciogest": "start_ms",
    "fdfecfingest": "end_ms",
}
CASH = {
    "fidespid": "agency",
    "fitipodepto": "segment",
    "fdfechabono": "paid_at",
    "fisematrasomax": "arrears",
    "fisematrasomin": "arrears_min",
    "fidiasatraso": "days_late",
    "ficlasifcuenta": "account_class",
    "fidiasatrasoabono": "days_late_at_payment",
    "fnmontoabono": "payment",
    "fncargoautomatico": "auto_charge_due",
    "fnmontocargoautomatico": "auto_charge",
    "fnmontocaptacion": "captation",
    "fitipocartera": "portfolio_type",
    "fiindjudextraju": "judicial_flag",
    "fiorigencartera": "portfolio_origin",
    "fnsaldocte": "balance",
    "fnsaldoatrasadocte": "balance_late",
    "fnmoratorioscte": "interest_due",
    "fitelefonia": "telephony_flag",
}
SEGMENT_CHANGES = {
    "fitipodepto": "segment",
    "fitipodeptocambio": "new_segment",
    "fisemana": "period",
    "fnsaldo": "balance",
    "fisematras": "arrears",
    "fiperatraacum": "arrears_accumulated",
}
BALANCES = {
    "fecharegistrosemanal": "registered_on",
    "saldototalpendiente": "total_balance",
    "saldocapitalpendiente": "principal_balance",
    "periodoatrasoacumulado": "arrears_accumulated",
}
FLAT_KEY_BALANCES = {
    "id_cliente": "entity_id",
    "num_periodo_sem": "period",
    "sld_capital_pendiente": "principal_balance",
    "num_sem_atraso": "arrears_accumulated",
}


Only = Sequence[str] | None


def _named(
    df: DataFrame, names: Mapping[str, str], extra: Sequence[Column] = (), decoders: Decoders | None = None, only: Only = None, key: Sequence[str] = ()
) -> DataFrame:
    decode = decoders or {}
    if only is not None:
        if unknown := set(only) - set(names.values()):
            raise ValueError(f"no such column: {', '.join(sorted(unknown))}")
        names = {s: n for s, n in names.items() if n in only or n in key}
    if missing := [s for s in names if s not in df.columns]:
        raise ValueError(f"the source has no {', '.join(missing)}")

    def column(source: str, name: str) -> Column:
        value = F.col(source)
        return (decode[name](value) if name in decode else value).alias(name)

    return df.select(*extra, *[column(s, n) for s, n in names.items()])


def _entity(key: Mapping[str, str], require_all_parts: bool) -> Column:
    return composite_key(*key, require_all_parts=require_all_parts).alias("entity_id")


def _keyed(df, key, names, extra=(), decoders=None, require_all_parts=False, only=None):
    return _named(df, {**key, **names}, [_entity(key, require_all_parts), *extra], decoders, only, (*key.values(), "period"))


def _from_year(df: DataFrame, year: str, week: str, start_period: int | None) -> tuple[DataFrame, Column]:
    """Rows from a period on, with the derived period as a column.

    A derived period cannot be pushed into the scan; its year part can.
    """
    period = period_from_parts(year, week)
    if start_period is not None:
        df = df.where((F.col(year) >= start_period // 100) & (period >= start_period))
    return df, period.alias("period")


def agency_segments(table: DataFrame, segments: Sequence[int], only: Only = None) -> DataFrame:
    """Agency-segments of the given segments."""
    return _named(table.where(F.col("fitipodepto").isin(list(segments))), AGENCY_SEGMENT, only=only, key=("agency", "segment"))


def agency_master(table: DataFrame, decoders: Decoders | None = None, only: Only = None) -> DataFrame:
    """Agency master data; tax id and e-mail may need a decoder."""
    return _named(table, AGENCY_MASTER, decoders=decoders, only=only, key=("agency",))


def snapshot(table: DataFrame, start_period: int | None = None, require_all_parts: bool = False, only: Only = None) -> DataFrame:
    """Weekly client snapshots, all segments."""
    rows = table if start_period is None else table.where(F.col("fisemana") >= start_period)
    return _keyed(rows.where(F.col("fisemana").isNotNull()), KEY, SNAPSHOT, require_all_parts=require_all_parts, only=only)


def ledger(table: DataFrame, start_period: int | None = None, require_all_parts: bool = False, only: Only = None) -> DataFrame:
    """Recovery ledger; the table stores year and week apart."""
    rows, period = _from_year(table, "fianio", "fisemana", start_period)
    return _keyed(rows, KEY, LEDGER, [period], require_all_parts=require_all_parts, only=only)


def recoveries(table: DataFrame, start_period: int | None = None, require_all_parts: bool = False, only: Only = None) -> DataFrame:
    """Instalment recoveries by processing year and week."""
    rows, period = _from_year(table, "fianioproceso", "fisemproceso", start_period)
    return _keyed(rows, CUSTOMER_KEY, RECOVERIES, [period], require_all_parts=require_all_parts, only=only)


def recoveries_by_own_period(
    table: DataFrame, departments: Sequence[int] | None = None, start_period: int | None = None, require_all_parts: bool = False, only: Only = None
) -> DataFrame:
    """Instalment recoveries by the table's own period, of some departments or all."""
    rows = table if departments is None else table.where(F.col("fideptoid").isin(list(departments)))
    if start_period is not None:
        rows = rows.where(F.col("fisemana") >= start_period)
    return _keyed(rows, CUSTOMER_KEY, RECOVERIES, [F.col("fisemana").alias("period")], require_all_parts=require_all_parts, only=only)


def management_results(table: DataFrame, only: Only = None) -> DataFrame:
    """Management results by ``YYYYMMDD`` date (see ``calendar.with_period_of_date``)."""
    return _keyed(table, KEY, MANAGEMENT_RESULTS, only=only)


def visits(table: DataFrame, decoders: Decoders | None = None, only: Only = None) -> DataFrame:
    """Visits with GPS; the four coordinates may need a decoder."""
    return _keyed(table, CUSTOMER_KEY, VISITS, decoders=decoders, only=only)


def cash_payments(table: DataFrame, start_period: int | None = None, only: Only = None) -> DataFrame:
    """Cash payments with agency, segment and account state."""
    rows, period = _from_year(table, "fianio", "fisemana", start_period)
    return _keyed(rows, KEY, CASH, [period], only=only)


def segment_changes(table: DataFrame, only: Only = None) -> DataFrame:
    """Recorded segment changes."""
    return _keyed(table, KEY, SEGMENT_CHANGES, only=only)


def balances(table: DataFrame, only: Only = None) -> DataFrame:
    """Outstanding balances by registration day."""
    return _named(table, {**BALANCE_KEY, **BALANCES}, only=only, key=tuple(BALANCE_KEY.values()))


def flat_key_balances(table: DataFrame) -> DataFrame:
    """Outstanding balances by period, keyed by ``"a-b-c-d"`` text."""
    return _named(table, FLAT_KEY_BALANCES)


def day_calendar(table: DataFrame, year: str = "nanioekt", week: str = "nsemanaekt", day: str = "nfecha") -> DataFrame:
    """Day calendar; ``year`` chooses between week-year and calendar year."""
    return table.select(F.col(day).alias("day"), period_from_parts(year, week).alias("period"))


def week_limits(table: DataFrame, start_ms: str = "fcfecinicial", end_ms: str = "fcfectermino") -> DataFrame:
    """Week limits from epoch milliseconds."""
    return table.select(
        period_from_parts("fianioproceso", "fisemproceso").alias("period"),
        epoch_ms_to_date(start_ms).alias("start_date"),
        epoch_ms_to_date(end_ms).alias("end_date"),
    )
