"""DuckDB SQL per registered query."""

from __future__ import annotations

from . import adapters
from .oracle_views import with_views

LEGAL = "(4, 5)"


# The label texts and thresholds in the statements below are those of the established layout.


def _d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def _positive_ratio(numerator: str, denominator: str, default: str = "NULL") -> str:
    return f"CASE WHEN {_d(denominator)} > 0 THEN {_d(numerator)} / {_d(denominator)} ELSE {default} END"


# --- shared expressions ---------------------------------------------------------------

_LAST_SNAPSHOT = {
    "last_snapshot": """
        SELECT * FROM v_snapshot
        QUALIFY row_number() OVER (PARTITION BY entity_id, period ORDER BY opened_at DESC, record_id DESC) = 1"""
}
_LEDGER_AGG = {
    "ledger_last": """
        SELECT entity_id, period, agency, CASE WHEN active THEN 1 ELSE 0 END AS plan_active FROM v_ledger
        QUALIFY row_number() OVER (PARTITION BY entity_id, period
            ORDER BY managed_at DESC, order_id DESC, line DESC, manager DESC, agency DESC, price DESC) = 1""",
    "ledger_sum": """
        SELECT entity_id, period, sum(CASE WHEN capital + interest > 0 THEN capital + interest ELSE 0 END) AS collected,
               sum(auto_charge) AS auto_charge, sum(captation) AS captation, count(DISTINCT manager) AS n_managers
        FROM v_ledger GROUP BY ALL""",
    "ledger_agg": """
        SELECT *, CASE WHEN collected > 0 THEN 1 ELSE 0 END AS paid
        FROM ledger_sum JOIN ledger_last USING (entity_id, period)""",
}
_HISTORY = {
    "population": f"SELECT DISTINCT entity_id FROM v_snapshot WHERE period > 199501 AND segment IN {LEGAL}",
    "restricted": """
        SELECT * FROM v_snapshot WHERE period >= 199501 AND entity_id IN (SELECT entity_id FROM population)
        QUALIFY row_number() OVER (PARTITION BY entity_id, period ORDER BY opened_at DESC, record_id DESC) = 1""",
    **_LEDGER_AGG,
    "neighbours": """
        SELECT *, lag(coalesce(last_payment, 0) + coalesce(last_arrears_payment, 0)) OVER w AS required_payment,
               lag(arrears) OVER w AS prev_arrears, lag(arrears) OVER z AS next_arrears,
               lag(segment) OVER w AS prev_segment, lag(segment) OVER z AS next_segment
        FROM restricted
        WINDOW w AS (PARTITION BY entity_id ORDER BY period), z AS (PARTITION BY entity_id ORDER BY period DESC)""",
    "moves": f"""
        SELECT entity_id, period, segment, arrears, balance, n_actions, n_actions_unpaid, required_payment,
               prev_arrears, next_arrears,
               CASE WHEN arrears = prev_arrears + 1 THEN 1 ELSE 0 END AS roll_forward,
               CASE WHEN arrears = next_arrears + 1 THEN 1 ELSE 0 END AS roll_backward,
               CASE WHEN prev_arrears IS NULL THEN 0 ELSE 1 END AS with_prev_arrears,
               CASE WHEN next_arrears IS NULL THEN 0 ELSE 1 END AS with_next_arrears,
               prev_segment, next_segment,
               CASE WHEN segment IN {LEGAL} AND prev_segment NOT IN {LEGAL} THEN 1 ELSE 0 END AS enter_legal,
               CASE WHEN segment IN {LEGAL} AND next_segment NOT IN {LEGAL} THEN 1 ELSE 0 END AS out_legal,
               CASE WHEN segment IN {LEGAL} THEN 1 ELSE 0 END AS in_legal,
               CASE WHEN prev_segment IS NULL THEN 0 ELSE 1 END AS with_prev_segment,
               CASE WHEN next_segment IS NULL THEN 0 ELSE 1 END AS with_next_segment
        FROM neighbours""",
    "settled": """
        SELECT m.*, l.* EXCLUDE (entity_id, period),
               CASE WHEN in_legal = 1 AND collected >= balance THEN 1 ELSE 0 END AS debt_settled
        FROM moves m LEFT JOIN ledger_agg l USING (entity_id, period) WHERE agency IS NOT NULL""",
    "history": """
        SELECT *, CASE WHEN in_legal = 1 AND with_next_arrears = 0 AND with_next_segment = 0 AND debt_settled = 0
                       THEN 1 ELSE 0 END AS lost_track
        FROM settled WHERE period BETWEEN 199502 AND 200103""",
}
_HISTORY_VIEWS = ("v_snapshot", "v_ledger")

_MEASURES = {
    "collected": _d("collected"),
    "required_payment": _d("required"),
    "efficiency": _positive_ratio("collected", "required"),
    "n_actions": "CAST(actions AS BIGINT)",
    "pct_clients_managed": _positive_ratio("managed", "n_clients"),
    "pct_clients_paid": _positive_ratio("paid", "n_clients"),
    "pct_clients_settled": _positive_ratio("settled", "n_clients"),
    "pct_clients_lost_track": _positive_ratio("lost", "n_clients"),
    "pct_clients_left": _positive_ratio("left_legal", "n_clients"),
    "pct_clients_entered": _positive_ratio("entered", "n_clients"),
    "pct_clients_plan_active": _positive_ratio("plans", "n_clients"),
    "balance_per_client": _positive_ratio("balance", "n_clients"),
    "actions_per_client": _positive_ratio("actions", "n_clients"),
    "pct_effective_actions": _positive_ratio("actions - unpaid", "actions"),
    "pct_roll_forward": _positive_ratio("forward_rolls", "with_prev"),
    "pct_roll_backward": _positive_ratio("backward_rolls", "with_next"),
    "avg_arrears": "avg_arrears",
}


def _ratios(keys: str) -> str:
    measures = ", ".join(f"{e} AS {n}" for n, e in _MEASURES.items())
    return f"""
        SELECT {keys}, n_clients, {measures} FROM (
            SELECT {keys}, count(DISTINCT entity_id) AS n_clients,
                   count(DISTINCT CASE WHEN n_actions > 0 THEN entity_id END) AS managed,
                   sum(paid) AS paid, sum(debt_settled) AS settled, sum(lost_track) AS lost, sum(out_legal) AS left_legal,
                   sum(enter_legal) AS entered, sum(plan_active) AS plans, sum(collected) AS collected,
                   sum(required_payment) AS required, sum(balance) AS balance, sum(n_actions) AS actions,
                   sum(n_actions_unpaid) AS unpaid,
                   sum(CASE WHEN with_prev_arrears = 1 THEN roll_forward END) AS forward_rolls,
                   sum(with_prev_arrears) AS with_prev,
                   sum(CASE WHEN with_next_arrears = 1 THEN roll_backward END) AS backward_rolls,
                   sum(with_next_arrears) AS with_next, avg(arrears) AS avg_arrears
            FROM history WHERE segment IN {LEGAL} GROUP BY {keys})"""


_GLOBAL = {"ratios": _ratios("agency, segment")}
_WEEKLY = {"weekly": _ratios("agency, segment, period")}

# weekly measure -> trend
_TRENDS = {
    "efficiency": "efficiency",
    "avg_arrears": "arrears",
    "actions_per_client": "actions",
    "pct_effective_actions": "effective_actions",
    "pct_clients_paid": "paid",
    "pct_clients_settled": "settled",
    "pct_clients_managed": "managed",
    "pct_clients_lost_track": "lost_track",
    "pct_clients_left": "left",
    "pct_clients_entered": "entered",
    "pct_clients_plan_active": "plan_active",
    "balance_per_client": "balance_per_client",
    "pct_roll_forward": "roll_forward",
    "pct_roll_backward": "roll_backward",
}


def _slope(y: str) -> str:
    n, st, stt = f"CAST(count({y}) AS DOUBLE)", "sum(t ORDER BY t)", "sum(t * t ORDER BY t)"
    spread = f"({n} * {stt} - {st} * {st})"
    return f"CASE WHEN {spread} <> 0 THEN ({n} * sum(t * {y} ORDER BY t) - {st} * sum({y} ORDER BY t)) / {spread} END"


_SLOPES = {
    **_WEEKLY,
    "series": """
        SELECT *, CAST(row_number() OVER (PARTITION BY agency, segment ORDER BY period) AS DOUBLE) AS t FROM weekly""",
    "slopes": "SELECT agency, segment, count(period) AS n_periods_observed, "
    + ", ".join(f"{_slope(m)} AS slope_{n}" for m, n in _TRENDS.items())
    + ", stddev_samp(efficiency) AS std_efficiency FROM series GROUP BY agency, segment",
}


def _label(name: str) -> str:
    return (
        f"CASE WHEN n_periods_observed < 2 THEN 'Insuficiente' WHEN slope_{name} IS NULL THEN 'Sin datos' "
        f"WHEN slope_{name} < low_{name} THEN 'Decreciente' WHEN slope_{name} < high_{name} THEN 'Estable' "
        f"ELSE 'Creciente' END AS trend_{name}"
    )


_LABELS = {
    **_SLOPES,
    "cuts": "SELECT quantile_disc(std_efficiency, 0.5) AS mid, "
    + ", ".join(f"quantile_disc(slope_{n}, 0.33) AS low_{n}, quantile_disc(slope_{n}, 0.66) AS high_{n}" for n in _TRENDS.values())
    + " FROM slopes",
    "scored_trends": """
        SELECT *, CASE WHEN slope_efficiency >= high_efficiency THEN 1 ELSE 0 END
                + CASE WHEN slope_arrears <= low_arrears THEN 1 ELSE 0 END
                + CASE WHEN slope_roll_forward <= low_roll_forward THEN 1 ELSE 0 END AS trend_score
        FROM slopes, cuts""",
    "labels": "SELECT agency, segment, "
    + ", ".join(_label(n) for n in _TRENDS.values())
    + """, CASE WHEN std_efficiency IS NULL THEN 'Sin datos' WHEN std_efficiency <= mid THEN 'Consistente'
                ELSE 'Volatil' END AS stability_efficiency, trend_score,
          CASE trend_score WHEN 3 THEN 'Top' WHEN 2 THEN 'Positiva' WHEN 1 THEN 'Mixta' ELSE 'En riesgo' END AS trend_profile
        FROM scored_trends""",
}
_CATEGORIES = """
    CASE WHEN efficiency IS NULL THEN 'Sin datos' WHEN efficiency >= CAST(0.6 AS DOUBLE) THEN 'Alta eficiencia'
         WHEN efficiency >= CAST(0.3 AS DOUBLE) THEN 'Eficiencia media' ELSE 'Baja eficiencia' END AS cat_efficiency,
    CASE WHEN pct_clients_managed >= CAST(0.7 AS DOUBLE) THEN 'Gestión intensa'
         WHEN pct_clients_managed >= CAST(0.4 AS DOUBLE) THEN 'Gestión moderada' ELSE 'Gestión escasa' END AS cat_management_intensity,
    CASE WHEN pct_clients_paid >= CAST(0.7 AS DOUBLE) THEN 'Gestión intensa'
         WHEN pct_clients_paid >= CAST(0.4 AS DOUBLE) THEN 'Gestión moderada' ELSE 'Gestión escasa' END AS cat_effective_management"""
_FEATURES = {
    **_HISTORY,
    **_GLOBAL,
    **_LABELS,
    "features": f"""
        SELECT r.*, {_CATEGORIES}, {_d("n_clients")} / 26 AS avg_clients, l.* EXCLUDE (agency, segment)
        FROM ratios r LEFT JOIN labels l USING (agency, segment)""",
}

# scored measure -> (weight, order that ranks the best first in the default orientation)
_SCORED = {
    "efficiency": (5, "DESC"),
    "pct_clients_paid": (4, "DESC"),
    "pct_clients_managed": (3, "DESC"),
    "avg_arrears": (3, "ASC"),
    "pct_roll_forward": (2, "ASC"),
    "pct_clients_lost_track": (2, "ASC"),
    "pct_clients_settled": (2, "DESC"),
    "actions_per_client": (1, "DESC"),
}
_TOTAL_WEIGHT = sum(w for w, _ in _SCORED.values())
_SCORE = {
    **_FEATURES,
    "percentiles": "SELECT agency, segment, "
    + ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN percent_rank() OVER (PARTITION BY segment ORDER BY {c} {o} NULLS LAST) * 100 END AS score_{c}_pct"
        for c, (_, o) in _SCORED.items()
    )
    + " FROM features",
    "final": "SELECT *, CAST(0 AS DOUBLE) + "
    + " + ".join(
        f"coalesce(score_{c}_pct * (CAST({w} AS DOUBLE) / CAST({_TOTAL_WEIGHT} AS DOUBLE)), CAST(0 AS DOUBLE))"
        for c, (w, _) in _SCORED.items()
    )
    + " AS score_final FROM percentiles",
}

# --- agency master data ---------------------------------------------------------------

_CAPACITIES = ("ideal_capacity", "min_capacity", "max_capacity")


def _outliers(source: str) -> str:
    cleaned = ", ".join(
        f"CASE WHEN {c} = 0 OR {c} > (SELECT quantile_disc({c}, 0.95) FROM {source}) THEN NULL ELSE {c} END AS {c}" for c in _CAPACITIES
    )
    return f"SELECT * REPLACE ({cleaned}) FROM {source}"


def _medians(source: str) -> str:
    filled = ", ".join(f"coalesce({c}, (SELECT quantile_disc(m.{c}, 0.5) FROM {source} m WHERE m.segment = s.segment)) AS {c}" for c in _CAPACITIES)
    return f"SELECT * REPLACE ({filled}) FROM {source} s"


_BOUNDS = "least(min_capacity, ideal_capacity) AS min_capacity, greatest(max_capacity, ideal_capacity) AS max_capacity"
_STATUS = "CASE WHEN status = 1 THEN NULL WHEN status = 0 AND end_ms IS NULL THEN 1700000000000 ELSE end_ms END AS end_ms"
_TENURE = """CASE WHEN end_ms IS NULL OR start_ms IS NULL THEN 0
    ELSE CAST(date_diff('day', CAST(epoch_ms(start_ms) AS DATE), CAST(epoch_ms(end_ms) AS DATE)) AS INTEGER) END AS seniority_days"""
_TEXT_COLUMNS = ("legal_name", "tax_id", "email", "tax_suffix", "postcode", "phone", "external_company", "start_ms", "end_ms")
_NUMERIC_COLUMNS = (
    "agency", "segment", "status", *_CAPACITIES, "current_clients", "agency_type", "management_type",
    "experience", "tax_person_type", "interface_enabled", "start_ms", "end_ms",
)
_EMPTIES = " + ".join(
    [f"CASE WHEN {c} IS NULL OR {c} = 0 THEN 1 ELSE 0 END" for c in _NUMERIC_COLUMNS]
    + [f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _TEXT_COLUMNS if c not in _NUMERIC_COLUMNS]
)
_SPARSE = f"{_EMPTIES} <= 21.0 / 2 + 1"


def _flag(condition: str, name: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END AS {name}"


def _cleaned(column: str) -> str:
    return f"trim(regexp_replace({column}, '[\\t\\n\\r]', '', 'g'))"


_VALIDITY = ", ".join(
    [
        _flag("regexp_matches(phone, '^[0-9]{10,12}$')", "valid_phone"),
        _flag("regexp_matches(postcode, '^[0-9]{5,5}$')", "valid_postcode"),
        _flag("length(trim(external_company)) > 5 AND regexp_matches(trim(external_company), '[A-Za-z]')", "has_external_collection"),
        _flag("length(trim(legal_name)) > 5 AND regexp_matches(trim(legal_name), '[A-Za-z]')", "has_legal_name"),
        _flag(f"regexp_matches({_cleaned('email')}, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]{{2,}}$')", "valid_email"),
        _flag(f"regexp_matches({_cleaned('tax_id')}, '(?i)^[A-ZÑ&]{{3,4}}\\d{{6}}$')", "valid_tax_id"),
        _flag(f"regexp_matches({_cleaned('tax_suffix')}, '^[A-Za-z0-9]{{3}}$')", "valid_tax_suffix"),
    ]
)
_RANGE = "max_capacity - min_capacity"
_CAPACITY_RATIOS = ", ".join(
    [
        f"{_positive_ratio('min_capacity', 'ideal_capacity', '0')} AS min_over_ideal_capacity",
        f"{_positive_ratio('min_capacity', 'max_capacity', '0')} AS min_over_max_capacity",
        f"{_RANGE} AS capacity_range",
        f"{_positive_ratio(_RANGE, 'ideal_capacity')} AS range_over_ideal_capacity",
        f"{_positive_ratio(_RANGE, 'max_capacity')} AS range_over_max_capacity",
    ]
)
_PROFILE = {
    "p1": f"SELECT * REPLACE (coalesce(external_company, '') AS external_company, {_STATUS}) FROM v_base WHERE {_SPARSE}",
    "p2": _outliers("p1"),
    "p3": _medians("p2"),
    "p4": f"SELECT * REPLACE ({_BOUNDS}) FROM p3",
    "profile": f"""
        SELECT * EXCLUDE (phone, postcode, external_company, legal_name, email, tax_id, tax_suffix, start_ms, end_ms),
               {_VALIDITY}, {_TENURE}, {_CAPACITY_RATIOS} FROM p4""",
}
# The batch run cuts its profile to the legal segments and scores the data set, not the features.
_BATCH_PROFILE = {"legal_base": f"SELECT * FROM v_base WHERE segment IN {LEGAL}"} | {k: sql.replace("v_base", "legal_base") for k, sql in _PROFILE.items()}
_BATCH = {**_FEATURES, **_BATCH_PROFILE, "data_set": "SELECT * FROM profile JOIN features USING (agency, segment)"}
_BATCH_SCORE = _BATCH | {k: _SCORE[k].replace("FROM features", "FROM data_set") for k in ("percentiles", "final")}
_CHECKED = ("segment", "status", "agency_type", "management_type", "interface_enabled")
_SNAPSHOT_COLUMNS = (
    "entity_id", "country", "channel", "branch", "folio", "period", "segment", "arrears", "balance", "last_payment",
    "last_arrears_payment", "n_actions", "n_actions_unpaid", "opened_at", "record_id",
)


def _column_profile(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) - count({column}) AS nulls, count(DISTINCT {column}) AS "distinct",
        count({column}) AS non_nulls, round({_d(f"count(*) - count({column})")} / count(*) * 100, 2) AS pct_nulls FROM v_snapshot"""


# --- funnels --------------------------------------------------------------------------


def _ratio0(numerator: str, denominator: str, name: str) -> str:
    return f"{_positive_ratio(numerator, denominator, '0')} AS {name}"


def _funnel(minutes: str, snapshot_filter: str, population: str, department: str) -> dict[str, str]:
    return {
        "members": population,
        "contacts": f"""
            SELECT entity_id, period, count(*) AS n_visits, sum(direct_contact) AS direct, sum(effective_contact) AS effective
            FROM v_measured WHERE visit_code < 200 AND visit_code <> 50 AND dist_m < 100 AND minutes >= {minutes} GROUP BY ALL""",
        "receipts": """
            SELECT entity_id, period, sum(greatest(coalesce(capital, 0), 0)) + sum(greatest(coalesce(interest, 0), 0)) AS collected
            FROM v_event_payments GROUP BY ALL""",
        "records": f"""
            SELECT s.* EXCLUDE (department), {department} AS department
            FROM v_event_snapshot s JOIN members m USING (entity_id) WHERE {snapshot_filter}
            QUALIFY row_number() OVER (PARTITION BY entity_id, period ORDER BY opened_at DESC, record_id DESC) = 1""",
        "timeline": """
            SELECT *, lag(greatest(coalesce(last_payment, 0), 0) + greatest(coalesce(last_arrears_payment, 0), 0)) OVER w AS due,
                   lag(arrears) OVER w AS prev_arrears
            FROM records WINDOW w AS (PARTITION BY entity_id ORDER BY period)""",
        "joined": """
            SELECT t.*, coalesce(n_visits, 0) AS visits, coalesce(direct, 0) AS direct, coalesce(effective, 0) AS effective,
                   CAST(coalesce(collected, 0) AS DECIMAL(38,2)) AS collected, CAST(coalesce(due, 0) AS DECIMAL(38,0)) AS required
            FROM timeline t LEFT JOIN contacts USING (entity_id, period) LEFT JOIN receipts USING (entity_id, period)""",
        "totals": """
            SELECT period, count(DISTINCT entity_id) AS n_clients, count(DISTINCT department) AS n_departments,
                   CAST(sum(visits) AS BIGINT) AS n_visits, CAST(sum(direct) AS BIGINT) AS n_direct_contacts,
                   CAST(sum(effective) AS BIGINT) AS n_effective_contacts,
                   CAST(sum(collected) AS DOUBLE) AS collected_total, CAST(sum(required) AS DOUBLE) AS required_payment_total,
                   avg(arrears) AS avg_arrears,
                   CAST(sum(CASE WHEN arrears = prev_arrears + 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_roll_forward,
                   count(prev_arrears) AS n_with_prev,
                   count(DISTINCT CASE WHEN visits > 0 THEN entity_id END) AS n_visited
            FROM joined GROUP BY period""",
    }


_FUNNEL_VIEWS = ("v_event_snapshot", "v_measured", "v_event_payments")
_PERIOD_FUNNEL = _funnel(
    "1",
    "TRUE",
    """SELECT entity_id, min(department) AS entry_department FROM v_event_snapshot
       WHERE period = 202402 AND segment = 1 AND department IN (0, 1, 2) AND arrears BETWEEN 2 AND 6 GROUP BY entity_id""",
    "m.entry_department",
)
_CONTACT_FUNNEL = _funnel(
    "0.5",
    "period BETWEEN 202400 AND 202406",
    "SELECT DISTINCT entity_id FROM v_events WHERE event_type = 'error'",
    "s.department",
)

_BOUNDED_FUNNEL = {n: q.replace("WHERE TRUE", "WHERE period >= 202401") for n, q in _PERIOD_FUNNEL.items()}
_CURRENT_FUNNEL, _NON_CURRENT_FUNNEL = (
    {n: q.replace("period BETWEEN 202400 AND 202406", f"period BETWEEN 202402 AND 202404 AND segment {side} 3") for n, q in _CONTACT_FUNNEL.items()}
    for side in ("=", "<>")
)

# --- cohort ---------------------------------------------------------------------------

_KEY = "country, channel, branch, folio"
_ENTRIES = {
    "moving": f"""
        SELECT * FROM v_snapshot WHERE period BETWEEN 200001 AND 200003 AND segment IN (4, 5)
        QUALIFY row_number() OVER (PARTITION BY period, {_KEY} ORDER BY opened_at DESC, record_id DESC) = 1""",
    "entries": f"""
        SELECT {_KEY}, segment, arrears_at_entry, balance_at_entry, prev_period, prev_segment FROM (
            SELECT *, greatest(arrears, 0) AS arrears_at_entry, balance AS balance_at_entry,
                   lag(period) OVER w AS prev_period, lag(segment) OVER w AS prev_segment
            FROM moving WINDOW w AS (PARTITION BY {_KEY} ORDER BY period))
        WHERE period = 200003 AND segment = 5 AND prev_segment = 4""",
}
_ARREARS = {
    "arrears_rows": f"""
        SELECT period, {_KEY}, arrears, segment FROM (
            SELECT *, row_number() OVER (PARTITION BY period, {_KEY} ORDER BY opened_at DESC, record_id DESC) AS rn FROM v_snapshot)
        WHERE rn = 1 AND segment IN (5, 6, 15, 16, 28)"""
}
_BALANCES = {
    "v_balances": f"""
        SELECT {_KEY}, CASE WHEN record_id % 3 = 0 THEN CAST(opened_at AS DATE)
                    ELSE CAST(date_trunc('quarter', opened_at) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) END AS registered_on,
               order_total AS total_balance, account_balance AS principal_balance,
               CAST(record_id % 9 AS INTEGER) AS arrears_accumulated
        FROM v_orders""",
    "closing_balances": f"""
        SELECT c.period, {_KEY}, sum(total_balance) AS total_balance, sum(principal_balance) AS principal_balance,
               max(arrears_accumulated) AS arrears_accumulated
        FROM v_balances JOIN (SELECT period, max(day) AS last_day FROM v_calendar WHERE period BETWEEN 199501 AND 200103 GROUP BY period) c
             ON registered_on = c.last_day
        WHERE principal_balance >= 0 GROUP BY ALL""",
}


def _payments(keys: str) -> str:
    return f"""
        SELECT {keys}, period, sum(CASE WHEN capital + interest > 0 THEN capital + interest ELSE 0 END) AS payment,
               max(CASE WHEN capital + interest > 0 THEN 1 ELSE 0 END) AS payment_indicator
        FROM v_ledger GROUP BY ALL"""


_FOLLOWUP = {
    **_ENTRIES,
    **_ARREARS,
    **_BALANCES,
    "paid": _payments(_KEY),
    "paid_so_far": f"""
        SELECT *, sum(payment) OVER (PARTITION BY {_KEY} ORDER BY period ROWS UNBOUNDED PRECEDING) AS payment_cumulative
        FROM paid WHERE period BETWEEN 200003 AND 200103""",
}

# --- roll-up, row by row as the definition reads --------------------------------------

_ROLLUP = {
    "flow": """
        SELECT entity_id, agency, segment, period, sum(payment) AS payment_paid, count(*) AS n_payments_paid,
               arg_max(days_late, (paid_at, order_id, line, manager, price)) AS late_close
        FROM v_cash GROUP BY ALL""",
    "closing": """
        SELECT entity_id, agency, segment, period, days_late AS days_late_at_close, balance AS balance_at_close FROM v_cash
        QUALIFY row_number() OVER (PARTITION BY entity_id, agency, segment, period
            ORDER BY paid_at DESC, order_id DESC, line DESC, manager DESC, price DESC, days_late DESC, balance DESC) = 1""",
    "rows_joined": """
        SELECT l.*, f.payment_paid, f.n_payments_paid, c.days_late_at_close, c.balance_at_close
        FROM v_ledger l LEFT JOIN flow f USING (entity_id, agency, segment, period)
             LEFT JOIN closing c USING (entity_id, agency, segment, period)""",
    "weeks": """
        SELECT agency, segment, period, count(DISTINCT entity_id) AS n_clients, sum(capital) AS capital,
               sum(payment_paid) AS payment_paid, avg(days_late) AS late, avg(CAST(commission_pct AS DOUBLE)) AS commission,
               sum(n_actions) AS n_actions, sum(n_payments_paid) AS n_payments
        FROM rows_joined GROUP BY ALL""",
}

_ROLLUP_FROM = {
    n: q.replace("FROM v_cash", "FROM (SELECT * FROM v_cash WHERE period >= 200003)").replace("FROM v_ledger", "FROM (SELECT * FROM v_ledger WHERE period >= 200003)")
    for n, q in _ROLLUP.items()
}

# --- statements -----------------------------------------------------------------------


def statements() -> dict[str, str]:
    """SQL of every query."""
    return _own_statements() | adapters.statements()


def _own_statements() -> dict[str, str]:
    v = with_views
    history = {**_HISTORY}
    score_columns = ", ".join(f"round(score_{c}_pct, 9) AS score_{c}_pct" for c in _SCORED)
    found = """
        SELECT '11 back' AS lookup, min(period) AS period FROM (SELECT DISTINCT period FROM v_calendar WHERE period < 200103 ORDER BY period DESC LIMIT 11)
        UNION ALL SELECT '3 forward', max(period) FROM (SELECT DISTINCT period FROM v_calendar WHERE period > 199501 ORDER BY period LIMIT 3)
        UNION ALL SELECT 'too far back', min(period) FROM (SELECT DISTINCT period FROM v_calendar WHERE period < 199502 ORDER BY period DESC LIMIT 40)
        UNION ALL SELECT 'none', min(period) FROM (SELECT DISTINCT period FROM v_calendar WHERE period < 199501 ORDER BY period DESC LIMIT 1)"""
    base_keys = "SELECT agency, segment"
    capacities = ", ".join(_CAPACITIES)
    return {
        "composite_key": """
            SELECT c_custkey, c_nationkey || '-1-' || (c_custkey % 10) || '-' || c_custkey AS entity_id,
                   CASE WHEN c_nationkey = 3 THEN '' ELSE c_nationkey || '-' END || '1-' || (c_custkey % 10) || '-' || c_custkey AS gap_key
            FROM customer""",
        "period_from_parts": "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS period FROM orders",
        "period_around": v(("v_calendar",), {}, found),
        "period_limits": v(("v_limits",), {}, "SELECT * FROM v_limits"),
        "period_of_date": v(("v_actions",), {}, "SELECT order_id, line, yyyymmdd, period_of_date AS period FROM v_actions"),
        "snapshot_last_record": v(
            ("v_snapshot",), _LAST_SNAPSHOT, f"SELECT entity_id, period, segment, arrears, {_d('balance')} AS balance, record_id FROM last_snapshot"
        ),
        "ledger_last_record": v(("v_ledger",), _LEDGER_AGG, "SELECT * FROM ledger_last"),
        "entity_population": v(("v_snapshot",), {}, f"SELECT DISTINCT entity_id FROM v_snapshot WHERE period > 199501 AND segment IN {LEGAL}"),
        "ledger_entity_period": v(
            ("v_ledger",),
            _LEDGER_AGG,
            f"SELECT entity_id, period, {_d('collected')} AS collected, {_d('auto_charge')} AS auto_charge, {_d('captation')} AS captation, "
            "n_managers, agency, plan_active, paid FROM ledger_agg",
        ),
        "multi_channel_flag": v(
            ("v_ledger",), {}, "SELECT entity_id, period, CASE WHEN count(DISTINCT collection_type) > 1 THEN 1 ELSE 0 END AS multi_channel FROM v_ledger GROUP BY ALL"
        ),
        "managed_actions": v(
            ("v_actions",),
            {},
            "SELECT entity_id, period_of_date AS period, count(*) AS n_actions, count(DISTINCT manager) AS n_managers FROM v_actions WHERE action_code >= 800 GROUP BY ALL",
        ),
        "managed_actions_from": v(
            ("v_actions",),
            {},
            """SELECT entity_id, period_of_date AS period, count(*) AS n_actions, count(DISTINCT manager) AS n_managers
               FROM v_actions WHERE action_code >= 800 AND (period_of_date >= 200003 OR period_of_date IS NULL) GROUP BY ALL""",
        ),
        "period_lookup": v(("v_calendar",), {}, "SELECT period, min(day) AS start_date, max(day) AS end_date FROM v_calendar WHERE period = 200003 GROUP BY period"),
        "payments_by_period": v(
            ("v_ledger",), {"p": _payments("entity_id")}, f"SELECT entity_id, period, {_d('payment')} AS payment, payment_indicator FROM p"
        ),
        "payments_cumulative": v(
            ("v_ledger",),
            {"p": _payments("entity_id")},
            f"SELECT entity_id, period, {_d('payment')} AS payment, payment_indicator, "
            f"{_d('sum(payment) OVER (PARTITION BY entity_id ORDER BY period ROWS UNBOUNDED PRECEDING)')} AS payment_cumulative FROM p",
        ),
        "payment_flow_and_close": v(
            ("v_cash",),
            {
                "s": "SELECT entity_id, agency, segment, period, sum(payment) p, sum(auto_charge_due) d, sum(auto_charge) a, sum(captation) c, count(*) n FROM v_cash GROUP BY ALL",
                "l": """SELECT * FROM v_cash QUALIFY row_number() OVER (PARTITION BY entity_id, agency, segment, period
                    ORDER BY paid_at DESC, order_id DESC, line DESC, manager DESC, price DESC, arrears DESC, days_late DESC, account_class DESC, balance DESC, balance_late DESC, interest_due DESC) = 1""",
            },
            f"""SELECT entity_id, agency, segment, period, {_d("p")} AS payment_paid, {_d("d")} AS auto_charge_due_paid,
                {_d("a")} AS auto_charge_paid, {_d("c")} AS captation_paid, n AS n_payments_paid, l.arrears AS arrears_at_close,
                l.days_late AS days_late_at_close, l.account_class AS account_class_at_close, {_d("l.balance")} AS balance_at_close,
                l.days_late_at_payment AS days_late_at_payment_at_close, l.portfolio_type AS portfolio_type_at_close,
                l.judicial_flag AS judicial_flag_at_close, l.portfolio_origin AS portfolio_origin_at_close,
                {_d("l.balance_late")} AS balance_late_at_close, {_d("l.interest_due")} AS interest_due_at_close, l.telephony_flag AS telephony_flag_at_close
                FROM s JOIN l USING (entity_id, agency, segment, period)""",
        ),
        "required_payment": v(
            ("v_snapshot",),
            _LAST_SNAPSHOT,
            f"SELECT entity_id, period, {_d('lag(coalesce(last_payment, 0) + coalesce(last_arrears_payment, 0)) OVER (PARTITION BY entity_id ORDER BY period)')} AS required_payment FROM last_snapshot",
        ),
        "required_payment_clamped": v(
            ("v_snapshot",),
            _LAST_SNAPSHOT,
            f"SELECT entity_id, period, {_d('coalesce(lag(greatest(coalesce(last_payment, 0), 0) + greatest(coalesce(last_arrears_payment, 0), 0)) OVER (PARTITION BY entity_id ORDER BY period), 0)')} AS required_payment FROM last_snapshot",
        ),
        "arrears_roll": v(
            ("v_snapshot",),
            {**_LAST_SNAPSHOT, **{k: s.replace("FROM restricted", "FROM last_snapshot") for k, s in history.items() if k in ("neighbours", "moves")}},
            "SELECT entity_id, period, arrears, prev_arrears, next_arrears, roll_forward, roll_backward, with_prev_arrears, with_next_arrears FROM moves",
        ),
        "segment_transitions": v(
            ("v_snapshot",),
            {**_LAST_SNAPSHOT, **{k: s.replace("FROM restricted", "FROM last_snapshot") for k, s in history.items() if k in ("neighbours", "moves")}},
            "SELECT entity_id, period, segment, prev_segment, next_segment, enter_legal, out_legal, in_legal, with_prev_segment, with_next_segment FROM moves",
        ),
        "history_base": v(
            _HISTORY_VIEWS,
            history,
            f"""SELECT * REPLACE ({_d("balance")} AS balance, {_d("required_payment")} AS required_payment, {_d("collected")} AS collected,
                {_d("auto_charge")} AS auto_charge, {_d("captation")} AS captation) FROM history""",
        ),
        "agency_ratios": v(_HISTORY_VIEWS, {**history, **_GLOBAL}, "SELECT * FROM ratios"),
        "agency_ratios_by_period": v(_HISTORY_VIEWS, {**history, **_WEEKLY}, "SELECT * FROM weekly"),
        "ratio_categories": v(_HISTORY_VIEWS, {**history, **_GLOBAL}, f"SELECT agency, segment, {_CATEGORIES} FROM ratios"),
        "trend_slopes": v(
            _HISTORY_VIEWS,
            {**history, **_SLOPES},
            "SELECT agency, segment, n_periods_observed, "
            + ", ".join(f"round(slope_{n}, 9) AS slope_{n}" for n in _TRENDS.values())
            + ", round(std_efficiency, 9) AS std_efficiency FROM slopes",
        ),
        "trend_labels": v(_HISTORY_VIEWS, {**history, **_LABELS}, "SELECT * EXCLUDE (trend_score, trend_profile) FROM labels"),
        "trend_profile": v(_HISTORY_VIEWS, {**history, **_LABELS}, "SELECT agency, segment, trend_score, trend_profile FROM labels"),
        "agency_features": v(_HISTORY_VIEWS, _FEATURES, "SELECT * FROM features"),
        "agency_score": v(
            _HISTORY_VIEWS,
            _SCORE,
            f"""SELECT agency, segment, {score_columns}, round(score_final, 9) AS score_final,
                CAST(rank() OVER (PARTITION BY segment ORDER BY score_final DESC) AS INTEGER) AS rank,
                CASE WHEN score_final >= 80 THEN 'Élite' WHEN score_final >= 60 THEN 'Buen desempeño'
                     WHEN score_final >= 40 THEN 'Desempeño medio' WHEN score_final >= 20 THEN 'Bajo desempeño' ELSE 'Crítico' END AS band
                FROM final""",
        ),
        "agency_score_split": v(
            _HISTORY_VIEWS,
            _SCORE,
            f"""SELECT agency, segment, {score_columns}, round(score_final, 9) AS score_final,
                CAST(rank() OVER (PARTITION BY segment ORDER BY score_final DESC) AS INTEGER) AS rank,
                CASE WHEN score_final >= 80 THEN 'Élite' WHEN score_final >= 60 THEN 'Buen desempeño'
                     WHEN score_final >= 40 THEN 'Desempeño medio' WHEN score_final >= 20 THEN 'Bajo desempeño' ELSE 'Crítico' END AS band
                FROM final""",
        ),
        "batch_run_scored": v(
            (*_HISTORY_VIEWS, "v_base"),
            _BATCH_SCORE,
            f"""SELECT agency, segment, {score_columns}, round(score_final, 9) AS score_final,
                CAST(rank() OVER (PARTITION BY segment ORDER BY score_final DESC) AS INTEGER) AS rank,
                CASE WHEN score_final >= 80 THEN 'Élite' WHEN score_final >= 60 THEN 'Buen desempeño'
                     WHEN score_final >= 40 THEN 'Desempeño medio' WHEN score_final >= 20 THEN 'Bajo desempeño' ELSE 'Crítico' END AS band
                FROM final""",
        ),
        "batch_run": v((*_HISTORY_VIEWS, "v_base"), _BATCH, "SELECT * FROM data_set"),
        "batch_run_history": v(
            _HISTORY_VIEWS,
            history,
            f"""SELECT * REPLACE ({_d("balance")} AS balance, {_d("required_payment")} AS required_payment, {_d("collected")} AS collected,
                {_d("auto_charge")} AS auto_charge, {_d("captation")} AS captation) FROM history WHERE period BETWEEN 199502 AND 200103""",
        ),
        "batch_update_history": v(
            _HISTORY_VIEWS,
            history,
            f"""SELECT * REPLACE ({_d("balance")} AS balance, {_d("required_payment")} AS required_payment, {_d("collected")} AS collected,
                {_d("auto_charge")} AS auto_charge, {_d("captation")} AS captation) FROM history WHERE period BETWEEN 199502 AND 200103""",
        ),
        "table_sink": v(("v_ledger",), {"p": _payments("entity_id")}, f"SELECT entity_id, period, {_d('payment')} AS payment, payment_indicator FROM p"),
        "csv_sink": v(("v_ledger",), {"p": _payments("entity_id")}, f"SELECT entity_id, period, {_d('payment')} AS payment, payment_indicator FROM p"),
        "agency_base": v(("v_base",), {}, "SELECT * FROM v_base"),
        "null_fill": v(("v_base",), {}, f"{base_keys}, coalesce(external_company, '') AS external_company FROM v_base"),
        "sparse_row_drop": v(("v_base",), {}, f"{base_keys} FROM v_base WHERE {_SPARSE}"),
        "status_date_repair": v(("v_base",), {}, f"{base_keys}, status, {_STATUS} FROM v_base"),
        "outlier_null": v(("v_base",), {"c": _outliers("v_base")}, f"{base_keys}, {capacities} FROM c"),
        "median_impute": v(("v_base",), {"c": _outliers("v_base"), "m": _medians("c")}, f"{base_keys}, {capacities} FROM m"),
        "median_impute_exact": v(("v_base",), {"c": _outliers("v_base"), "m": _medians("c")}, f"{base_keys}, {capacities} FROM m"),
        "ledger_of_population": v(
            ("v_snapshot", "v_ledger"),
            {},
            f"""SELECT entity_id, period, agency, manager, {_d("capital")} AS capital FROM v_ledger
                WHERE entity_id IN (SELECT entity_id FROM v_snapshot WHERE period > 200102 AND segment IN {LEGAL})""",
        ),
        "balance_quantiles": v(
            ("v_snapshot",),
            {},
            " UNION ALL ".join(
                f"SELECT segment, CAST({q} AS DOUBLE) AS quantile, {_d(f'quantile_disc(balance, {q})')} AS balance FROM v_snapshot GROUP BY segment" for q in (0.5, 0.95)
            ),
        ),
        "capacity_bounds": v(("v_base",), {}, f"{base_keys}, ideal_capacity, {_BOUNDS} FROM v_base"),
        "capacity_ratios": v(("v_base",), {}, f"{base_keys}, {_CAPACITY_RATIOS} FROM v_base"),
        "field_validity": v(("v_base",), {}, f"{base_keys}, {_VALIDITY} FROM v_base"),
        "tenure_days": v(
            ("v_base",),
            {"r": f"SELECT * REPLACE ({_STATUS}) FROM v_base"},
            f"{base_keys}, CAST(epoch_ms(start_ms) AS DATE) AS start_date, {_TENURE} FROM r",
        ),
        "agency_profile": v(("v_base",), _PROFILE, "SELECT * FROM profile"),
        "agency_dataset": v(
            (*_HISTORY_VIEWS, "v_base"), {**_FEATURES, **_PROFILE}, "SELECT * FROM profile JOIN features USING (agency, segment)"
        ),
        "value_frequencies": v(
            ("v_base",),
            {},
            " UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM v_base GROUP BY ALL""" for c in _CHECKED),
        ),
        "column_profile": v(("v_snapshot",), {}, " UNION ALL ".join(_column_profile(c) for c in _SNAPSHOT_COLUMNS)),
        "row_and_key_totals": v(("v_ledger",), {}, "SELECT count(*) AS n_rows, count(DISTINCT agency) AS n_distinct_keys FROM v_ledger"),
        "contact_type": v(("v_typed",), {}, "SELECT event_id, visit_code, result_code, contact_type, direct_contact, effective_contact FROM v_typed"),
        "visit_geo_valid": v(
            ("v_measured",), {}, "SELECT event_id, minutes, round(dist_m, 0) AS dist_m FROM v_measured WHERE dist_m < 100 AND minutes >= 1"
        ),
        "visit_counts": v(
            ("v_visits",), {}, "SELECT entity_id, period, count(*) AS n_visits FROM v_visits WHERE visit_code >= 800 GROUP BY ALL"
        ),
        "contacts_by_entity_period": v(
            ("v_measured",),
            {},
            """SELECT entity_id, period, count(*) AS n_visits, CAST(sum(direct_contact) AS BIGINT) AS n_direct_contacts,
               CAST(sum(effective_contact) AS BIGINT) AS n_effective_contacts
               FROM v_measured WHERE visit_code < 200 AND visit_code <> 50 AND dist_m < 100 AND minutes >= 1 GROUP BY ALL""",
        ),
        "collected_by_entity_period": v(
            ("v_event_payments",),
            {"r": _PERIOD_FUNNEL["receipts"]},
            f"SELECT entity_id, period, {_d('collected')} AS collected FROM r",
        ),
        "entry_population": v(
            ("v_event_snapshot",), {"m": _PERIOD_FUNNEL["members"]}, "SELECT entity_id, entry_department AS department FROM m"
        ),
        "period_funnel": v(
            _FUNNEL_VIEWS,
            _PERIOD_FUNNEL,
            f"""SELECT CASE WHEN period = 202402 THEN 'phase_i' ELSE 'phase' END AS phase, period, n_departments, n_clients, n_visits,
                {_ratio0("n_visits", "n_clients", "avg_visits_per_client")}, {_ratio0("n_visits", "n_visited", "avg_visits_per_visited_client")},
                n_direct_contacts, {_ratio0("n_direct_contacts", "n_visits", "pct_direct_contact")},
                {_ratio0("n_direct_contacts", "n_clients", "avg_direct_contacts_per_client")}, collected_total, required_payment_total,
                {_ratio0("collected_total", "required_payment_total", "efficiency")}, n_roll_forward, n_with_prev,
                {_ratio0("n_roll_forward", "n_with_prev", "pct_roll_forward")}, avg_arrears FROM totals""",
        ),
        "period_funnel_bounded": v(
            _FUNNEL_VIEWS,
            _BOUNDED_FUNNEL,
            f"""SELECT CASE WHEN period = 202402 THEN 'phase_i' ELSE 'phase' END AS phase, period, n_departments, n_clients, n_visits,
                {_ratio0("n_visits", "n_clients", "avg_visits_per_client")}, {_ratio0("n_visits", "n_visited", "avg_visits_per_visited_client")},
                n_direct_contacts, {_ratio0("n_direct_contacts", "n_visits", "pct_direct_contact")},
                {_ratio0("n_direct_contacts", "n_clients", "avg_direct_contacts_per_client")}, collected_total, required_payment_total,
                {_ratio0("collected_total", "required_payment_total", "efficiency")}, n_roll_forward, n_with_prev,
                {_ratio0("n_roll_forward", "n_with_prev", "pct_roll_forward")}, avg_arrears FROM totals WHERE period BETWEEN 202403 AND 202404""",
        ),
        "contact_funnel": v(
            _FUNNEL_VIEWS,
            _CONTACT_FUNNEL,
            f"""SELECT period, n_clients, n_visits, {_ratio0("n_visits", "n_clients", "avg_visits_per_client")},
                n_direct_contacts, {_ratio0("n_direct_contacts", "n_visits", "pct_direct_contact")},
                {_ratio0("n_direct_contacts", "n_clients", "avg_direct_contacts_per_client")},
                n_effective_contacts, {_ratio0("n_effective_contacts", "n_visits", "pct_effective_contact")},
                {_ratio0("n_effective_contacts", "n_clients", "avg_effective_contacts_per_client")},
                {_ratio0("collected_total", "required_payment_total", "efficiency")}, collected_total, required_payment_total
                FROM totals WHERE period BETWEEN 202401 AND 202405""",
        ),
        "contact_funnel_current": v(
            _FUNNEL_VIEWS,
            _CURRENT_FUNNEL,
            f"""SELECT period, n_clients, n_visits, {_ratio0("n_visits", "n_clients", "avg_visits_per_client")},
                n_direct_contacts, {_ratio0("n_direct_contacts", "n_visits", "pct_direct_contact")},
                {_ratio0("n_direct_contacts", "n_clients", "avg_direct_contacts_per_client")},
                n_effective_contacts, {_ratio0("n_effective_contacts", "n_visits", "pct_effective_contact")},
                {_ratio0("n_effective_contacts", "n_clients", "avg_effective_contacts_per_client")},
                {_ratio0("collected_total", "required_payment_total", "efficiency")}, collected_total, required_payment_total
                FROM totals WHERE period BETWEEN 202403 AND 202404""",
        ),
        "contact_funnel_non_current": v(
            _FUNNEL_VIEWS,
            _NON_CURRENT_FUNNEL,
            f"""SELECT period, n_clients, n_visits, {_ratio0("n_visits", "n_clients", "avg_visits_per_client")},
                n_direct_contacts, {_ratio0("n_direct_contacts", "n_visits", "pct_direct_contact")},
                {_ratio0("n_direct_contacts", "n_clients", "avg_direct_contacts_per_client")},
                n_effective_contacts, {_ratio0("n_effective_contacts", "n_visits", "pct_effective_contact")},
                {_ratio0("n_effective_contacts", "n_clients", "avg_effective_contacts_per_client")},
                {_ratio0("collected_total", "required_payment_total", "efficiency")}, collected_total, required_payment_total
                FROM totals WHERE period BETWEEN 202403 AND 202404""",
        ),
        "cohort_entry_from_snapshots": v(
            ("v_snapshot",), _ENTRIES, f"SELECT * REPLACE ({_d('balance_at_entry')} AS balance_at_entry) FROM entries"
        ),
        "cohort_entry_in_country": v(
            ("v_snapshot",),
            {n: q.replace("FROM v_snapshot WHERE", "FROM v_snapshot WHERE country = 10 AND") for n, q in _ENTRIES.items()},
            f"SELECT * REPLACE ({_d('balance_at_entry')} AS balance_at_entry) FROM entries",
        ),
        "cohort_entry_events": v(
            ("v_orders",),
            {},
            f"""SELECT {_KEY}, {_d("order_total")} AS balance_at_entry, CAST(record_id % 7 AS INTEGER) AS arrears_at_entry,
                CAST(record_id % 9 AS INTEGER) AS arrears_accumulated
                FROM v_orders WHERE segment = 4 AND record_id % 6 = 4 AND period = 200003""",
        ),
        "cohort_arrears": v(("v_snapshot",), _ARREARS, "SELECT * FROM arrears_rows"),
        "balance_at_close": v(
            ("v_orders", "v_calendar"),
            _BALANCES,
            f"SELECT * REPLACE ({_d('total_balance')} AS total_balance, {_d('principal_balance')} AS principal_balance) FROM closing_balances",
        ),
        "balance_split_key": v(
            ("v_orders",),
            {},
            f"SELECT period, {_KEY}, {_d('account_balance')} AS principal_balance, CAST(record_id % 9 AS INTEGER) AS arrears_accumulated FROM v_orders",
        ),
        "cohort_followup": v(
            ("v_snapshot", "v_ledger", "v_calendar"),
            _FOLLOWUP,
            f"""SELECT {_KEY}, a.period, a.arrears, {_d("balance_at_entry")} AS balance_at_entry, arrears_at_entry,
                {_d("payment")} AS payment, payment_indicator, {_d("payment_cumulative")} AS payment_cumulative,
                {_d("total_balance")} AS total_balance, {_d("principal_balance")} AS principal_balance, arrears_accumulated,
                CAST(200003 AS INTEGER) AS entry_period,
                CAST((a.period // 100) * 52 + a.period % 100 - (2000 * 52 + 3) AS INTEGER) AS periods_since_entry
                FROM arrears_rows a JOIN entries e USING ({_KEY}) LEFT JOIN paid_so_far USING (period, {_KEY})
                     LEFT JOIN closing_balances USING (period, {_KEY})
                WHERE a.period BETWEEN 200003 AND 200103""",
        ),
        "agency_history_rollup": v(
            ("v_ledger", "v_cash"),
            _ROLLUP,
            f"""SELECT agency, segment, avg(n_clients) AS avg_clients, max(n_clients) AS max_clients,
                {_d("sum(capital)")} / count(capital) AS avg_capital, {_d("sum(capital)")} AS total_capital,
                {_d("sum(payment_paid)")} / count(payment_paid) AS avg_payment_paid,
                {_d("sum(capital)")} / nullif({_d("sum(n_actions)")}, 0) AS capital_per_action,
                round(avg(late), 6) AS avg_days_late, max(late) AS worst_week_days_late,
                avg(n_actions) AS avg_actions, avg(n_payments) AS avg_payments,
                round(stddev_samp(CAST(capital AS DOUBLE)), 2) AS capital_volatility, round(avg(commission), 9) AS avg_commission
                FROM weeks GROUP BY agency, segment""",
        ),
        "agency_history_rollup_from": v(
            ("v_ledger", "v_cash"),
            _ROLLUP_FROM,
            f"""SELECT agency, segment, avg(n_clients) AS avg_clients, max(n_clients) AS max_clients,
                {_d("sum(capital)")} / count(capital) AS avg_capital, {_d("sum(capital)")} AS total_capital,
                {_d("sum(payment_paid)")} / count(payment_paid) AS avg_payment_paid,
                {_d("sum(capital)")} / nullif({_d("sum(n_actions)")}, 0) AS capital_per_action,
                round(avg(late), 6) AS avg_days_late, max(late) AS worst_week_days_late,
                avg(n_actions) AS avg_actions, avg(n_payments) AS avg_payments,
                round(stddev_samp(CAST(capital AS DOUBLE)), 2) AS capital_volatility, round(avg(commission), 9) AS avg_commission
                FROM weeks GROUP BY agency, segment""",
        ),
    }
