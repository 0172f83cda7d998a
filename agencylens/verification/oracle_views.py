"""SQL (DuckDB) counterparts of the views, as common table expressions.

Written from the meaning of the views, not from the Spark expressions.
"""

from __future__ import annotations

from ..operators.visits import flatten_codes
from ..sources.codes import CONTACT_CODES

_CODE_ROWS = ", ".join(f"({v}, {r}, '{t}')" for v, r, t in flatten_codes(CONTACT_CODES))

# name -> (names it builds on, body)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_orders": (
        (),
        """
        SELECT concat_ws('-', CAST(c_nationkey AS VARCHAR), '1', CAST(c_custkey % 10 AS VARCHAR), CAST(c_custkey AS VARCHAR)) AS entity_id,
               c_nationkey AS country, CAST(1 AS INTEGER) AS channel, c_custkey % 10 AS branch, c_custkey AS folio,
               o_orderkey AS record_id,
               CAST(year(o_orderdate) * 100 + quarter(o_orderdate) AS INTEGER) AS period,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS segment,
               CAST(o_totalprice AS DECIMAL(15,2)) AS order_total,
               CAST(c_acctbal AS DECIMAL(15,2)) AS account_balance,
               o_orderdate AS opened_at
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    "v_snapshot": (
        ("v_orders",),
        """
        SELECT entity_id, country, channel, branch, folio, period, segment,
               CAST(record_id % 7 AS INTEGER) AS arrears, order_total AS balance,
               CASE WHEN record_id % 11 <> 0 THEN order_total * CAST(0.05 AS DECIMAL(3,2)) END AS last_payment,
               account_balance AS last_arrears_payment,
               CAST(record_id % 4 AS INTEGER) AS n_actions,
               CAST((record_id % 4) // 2 AS INTEGER) AS n_actions_unpaid,
               opened_at, record_id
        FROM v_orders""",
    ),
    "v_lines": (
        ("v_orders",),
        """
        SELECT l.*, o.*, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(l_discount AS DECIMAL(3,2)) AS discount, CAST(l_tax AS DECIMAL(3,2)) AS tax
        FROM lineitem l JOIN v_orders o ON l.l_orderkey = o.record_id""",
    ),
    "v_ledger": (
        ("v_lines",),
        """
        SELECT entity_id, country, channel, branch, folio, period, segment, l_suppkey AS agency,
               price * (CAST(1 AS DECIMAL(3,2)) - discount) * CAST(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS DECIMAL(1,0)) AS capital,
               CASE WHEN l_linenumber <> 7 THEN price * tax END AS interest,
               CAST(l_quantity AS DECIMAL(15,2)) AS auto_charge, price * discount AS captation,
               l_partkey AS manager, l_linestatus = 'F' AS active, ascii(l_returnflag) AS collection_type,
               CAST(l_quantity AS INTEGER) AS days_late, discount AS commission_pct,
               CAST(l_partkey % 5 AS INTEGER) AS n_actions,
               l_shipdate AS managed_at, l_orderkey AS order_id, l_linenumber AS line, price
        FROM v_lines""",
    ),
    "v_cash": (
        ("v_lines",),
        """
        SELECT entity_id, l_suppkey AS agency, segment, period, price AS payment, price * tax AS auto_charge_due,
               CAST(l_quantity AS DECIMAL(15,2)) AS auto_charge, price * discount AS captation,
               l_linenumber AS arrears, CAST(l_quantity AS INTEGER) AS days_late, ascii(l_linestatus) AS account_class,
               CAST(l_partkey % 90 AS INTEGER) AS days_late_at_payment, CAST(l_partkey % 5 AS INTEGER) AS portfolio_type,
               CAST(l_orderkey % 2 AS INTEGER) AS judicial_flag, CAST(l_orderkey % 4 AS INTEGER) AS portfolio_origin,
               order_total AS balance, price * discount AS balance_late, price * tax AS interest_due,
               CAST(l_partkey % 2 AS INTEGER) AS telephony_flag, l_shipdate AS paid_at, l_orderkey AS order_id,
               l_linenumber AS line, l_partkey AS manager, price
        FROM v_lines""",
    ),
    "v_calendar": (
        (),
        """
        SELECT CAST(d AS DATE) AS day, CAST(year(d) * 100 + quarter(d) AS INTEGER) AS period
        FROM (SELECT unnest(generate_series(date_trunc('quarter', min(o_orderdate)),
                     date_trunc('quarter', max(o_orderdate)) + INTERVAL 3 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
              FROM orders)""",
    ),
    "v_limits": (
        ("v_calendar",),
        """
        SELECT period, min(day) AS start_date, max(day) AS end_date,
               CAST(row_number() OVER (ORDER BY period) AS INTEGER) AS period_index
        FROM v_calendar GROUP BY period""",
    ),
    "v_actions": (
        ("v_lines", "v_limits"),
        """
        SELECT entity_id, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS yyyymmdd,
               l_partkey % 7 * 50 + 600 AS action_code, l_suppkey AS manager, l_orderkey AS order_id,
               l_linenumber AS line, w.period AS period_of_date
        FROM v_lines LEFT JOIN v_limits w ON CAST(l_shipdate AS DATE) BETWEEN w.start_date AND w.end_date""",
    ),
    "v_base": (
        (),
        """
        SELECT s_suppkey AS agency, CAST(g AS INTEGER) AS segment,
               CAST(s_suppkey % 2 AS INTEGER) AS status,
               CAST((s_suppkey + g) % 50 AS INTEGER) AS ideal_capacity,
               CAST(s_suppkey % 60 AS INTEGER) AS min_capacity,
               CAST(s_suppkey % 90 AS INTEGER) AS max_capacity,
               CAST(s_suppkey % 300 AS INTEGER) AS current_clients,
               CAST(s_suppkey % 4 AS INTEGER) AS agency_type,
               CAST(s_suppkey % 3 AS INTEGER) AS management_type,
               CAST(s_suppkey % 10 AS INTEGER) AS experience,
               CASE WHEN k THEN s_name END AS legal_name,
               CASE WHEN k THEN (CASE WHEN s_suppkey % 5 = 1 THEN 'AB' ELSE 'ABC' END) || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') END AS tax_id,
               CASE WHEN NOT k THEN NULL WHEN s_suppkey % 4 = 1 THEN 'mail' || s_suppkey
                    ELSE ' mail' || chr(9) || s_suppkey || '@host.com' || chr(10) END AS email,
               CASE WHEN NOT k THEN NULL WHEN s_suppkey % 7 = 1 THEN 'A1' ELSE 'A1b' END AS tax_suffix,
               CAST(s_suppkey % 2 AS INTEGER) AS tax_person_type,
               CASE WHEN NOT k THEN NULL WHEN s_suppkey % 6 = 1 THEN lpad(CAST(s_suppkey AS VARCHAR), 4, '1')
                    ELSE lpad(CAST(s_suppkey AS VARCHAR), 5, '0') END AS postcode,
               CASE WHEN NOT k THEN NULL WHEN s_suppkey % 3 = 1 THEN lpad(CAST(s_suppkey AS VARCHAR), 9, '5')
                    ELSE lpad(CAST(s_suppkey AS VARCHAR), 11, '5') END AS phone,
               CASE WHEN k AND s_suppkey % 3 <> 0 THEN ' Partner ' || s_suppkey END AS external_company,
               CASE WHEN k THEN 1200000000000 + s_suppkey * 86400000 END AS start_ms,
               CASE WHEN k AND s_suppkey % 4 <> 0
                    THEN 1200000000000 + s_suppkey * 86400000 + (s_suppkey % 500) * 86400000 END AS end_ms,
               CAST(s_suppkey % 2 AS INTEGER) AS interface_enabled
        FROM (SELECT *, s_suppkey % 25 <> 0 AS k FROM supplier), generate_series(1, 5) AS t(g)""",
    ),
    "v_events": (
        (),
        """
        SELECT event_id, ts, CAST(user_id AS VARCHAR) AS entity_id, user_id,
               CAST(isoyear(ts) * 100 + weekofyear(ts) AS INTEGER) AS period,
               CAST(user_id % 3 AS INTEGER) AS department, event_type, value,
               CAST(value AS DECIMAL(15,2)) AS amount,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k
        FROM events""",
    ),
    "v_event_snapshot": (
        ("v_events",),
        """
        SELECT entity_id, period, department, CAST(event_id % 3 + 1 AS INTEGER) AS segment,
               CAST(event_id % 7 AS INTEGER) AS arrears,
               CASE WHEN event_id % 11 <> 0 THEN amount END AS last_payment,
               CAST(k - 50 AS DECIMAL(15,2)) AS last_arrears_payment, ts AS opened_at, event_id AS record_id
        FROM v_events""",
    ),
    "v_visits": (
        ("v_events",),
        """
        SELECT event_id, entity_id, period,
               CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 9 WHEN 'error' THEN 11 WHEN 'signup' THEN 32 ELSE k + 780 END AS INTEGER) AS visit_code,
               CAST(k % 12 AS INTEGER) AS result_code,
               CAST(19 AS DOUBLE) + CAST(user_id AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat_c,
               CAST(19 AS DOUBLE) + CAST(user_id AS DOUBLE) / CAST(1000 AS DOUBLE) + CAST(k AS DOUBLE) / CAST(100000 AS DOUBLE) AS lat_a,
               k % 17 = 0 AS unlocated,
               CAST(CAST(round(value * 1000) AS BIGINT) AS DOUBLE) / CAST(60000 AS DOUBLE) AS minutes
        FROM v_events""",
    ),
    "v_codes": ((), f"SELECT * FROM (VALUES {_CODE_ROWS}) AS c(visit_code, result_code, contact_type)"),
    "v_typed": (
        ("v_visits", "v_codes"),
        """
        SELECT v.*, coalesce(c.contact_type, 'sin_info') AS contact_type,
               CASE WHEN c.contact_type = 'contacto_directo' THEN 1 ELSE 0 END AS direct_contact,
               CASE WHEN visit_code = 1 OR (visit_code = 9 AND result_code = 3) OR (visit_code = 11 AND result_code = 4)
                         OR (visit_code = 32 AND result_code = 7) THEN 1 ELSE 0 END AS effective_contact
        FROM v_visits v LEFT JOIN v_codes c USING (visit_code, result_code)""",
    ),
    "v_measured": (
        ("v_typed",),
        """
        SELECT *, round(6371000 * acos(greatest(-1.0, least(1.0,
                   cos(radians(lat_a)) * cos(radians(lat_c)) + sin(radians(lat_a)) * sin(radians(lat_c))))), 2) AS dist_m
        FROM v_typed WHERE NOT unlocated""",
    ),
    "v_event_payments": (
        ("v_events",),
        """
        SELECT entity_id, period, department, amount AS capital,
               CASE WHEN k % 10 <> 0 THEN CAST(k - 50 AS DECIMAL(15,2)) END AS interest
        FROM v_events WHERE event_type = 'purchase'""",
    ),
}


def with_views(wanted: tuple[str, ...], extra: dict[str, str], body: str) -> str:
    """``WITH`` statement holding the wanted views, further expressions, and the body."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        needs, text = VIEWS[name]
        for need in needs:
            add(need)
        ordered.setdefault(name, text)

    for name in wanted:
        add(name)
    ordered.update(extra)
    parts = ",\n".join(f"{name} AS ({text})" for name, text in ordered.items())
    return f"WITH {parts}\n{body}" if parts else body
