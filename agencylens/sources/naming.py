"""Output names of the established report layout.

``established_names`` renames any output of this engine for readers that
expect those column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Canonical name -> established name.
HISTORY = {
    "entity_id": "client_id",
    "agency": "fidespid",
    "segment": "fitipodepto",
    "period": "fisemana",
    "arrears": "fisematrasomax",
    "balance": "fnsaldocte",
    "n_actions": "finogestiones",
    "n_actions_unpaid": "finogestsincobro",
    "required_payment": "pago_requerido",
    "prev_arrears": "prev_fisematrasomax",
    "next_arrears": "next_fisematrasomax",
    "with_prev_arrears": "with_prev_fisematrasomax",
    "with_next_arrears": "with_next_fisematrasomax",
    "prev_segment": "prev_fitipodepto",
    "next_segment": "next_fitipodepto",
    "with_prev_segment": "with_prev_fitipodepto",
    "with_next_segment": "with_next_fitipodepto",
    "plan_active": "actived_plan",
    "collected": "cobranza",
    "auto_charge": "fnmontocargoautomatico",
    "captation": "fnmontocaptacion",
    "n_managers": "n_gestors",
    "paid": "payment_indicator",
    "debt_settled": "deuda_saldada",
}
DATASET = {
    "agency": "fidespid",
    "segment": "fitipodepto",
    "status": "estatus",
    "ideal_capacity": "ideal_cap_manager",
    "min_capacity": "min_cap_manager",
    "max_capacity": "max_cap_manager",
    "agency_type": "fntipodespacho",
    "management_type": "fitipogestion",
    "experience": "fitiempomanejocobza",
    "tax_person_type": "fiidtipopersfiscal",
    "interface_enabled": "fihabilitadointerf",
    "valid_postcode": "valid_cp",
    "has_external_collection": "has_ext_collection",
    "has_legal_name": "has_razon_social",
    "valid_tax_id": "valid_rfc",
    "valid_tax_suffix": "valid_homoclave",
    "min_over_ideal_capacity": "min_over_ideal_cap_manager",
    "min_over_max_capacity": "min_over_max_cap_manager",
    "capacity_range": "rang_cap_manager",
    "range_over_ideal_capacity": "rang_over_ideal_cap_manager",
    "range_over_max_capacity": "rang_over_max_cap_manager",
    "period": "fisemana",
    "n_clients": "n_clientes",
    "collected": "cobranza",
    "required_payment": "pago_requerido",
    "efficiency": "eficiencia",
    "n_actions": "n_gestions",
    "pct_clients_managed": "pct_clientes_gestionados",
    "pct_clients_paid": "pct_clientes_pagaron",
    "pct_clients_settled": "pct_clientes_sin_deuda",
    "pct_clients_lost_track": "pct_clientes_lost_track",
    "pct_clients_left": "pct_clientes_salieron",
    "pct_clients_entered": "pct_clientes_entraron",
    "pct_clients_plan_active": "pct_clientes_con_plan_activo",
    "balance_per_client": "saldo_x_cliente",
    "actions_per_client": "gestiones_x_cliente",
    "pct_effective_actions": "pct_gestiones_efectivas",
    "avg_arrears": "avg_fisematrasomax",
    "avg_clients": "avg_clientes",
    "cat_efficiency": "cat_eficiencia",
    "cat_management_intensity": "cat_intensidad_gestion",
    "cat_effective_management": "cat_gestion_efectiva",
    "trend_efficiency": "tend_eficiencia",
    "trend_arrears": "tend_atraso",
    "trend_actions": "tend_gestions",
    "trend_effective_actions": "tend_gestions_sin_cobro",
    "trend_paid": "tend_pct_pagaron",
    "trend_settled": "tend_pct_sin_deuda",
    "trend_managed": "tend_pct_gestionados",
    "trend_lost_track": "tend_lost_track",
    "trend_left": "tend_salidas",
    "trend_entered": "tend_entradas",
    "trend_plan_active": "tend_actived_plan",
    "trend_balance_per_client": "tend_saldo_x_cliente",
    "trend_roll_forward": "tend_roll_forward",
    "trend_roll_backward": "tend_roll_backward",
    "stability_efficiency": "estabilidad_eficiencia",
    "trend_score": "score_tendencia",
    "trend_profile": "perfil_tendencia",
    "tax_info_complete": "info_fiscal_completa",
    "band": "segmento_despacho",
}
FUNNEL = {
    "phase": "fase",
    "period": "fisemana",
    "n_departments": "n_deptos",
    "n_clients": "n_clientes",
    "n_visits": "n_visitas",
    "avg_visits_per_client": "avg_visitas_x_cliente",
    "avg_visits_per_visited_client": "avg_visitas_x_cliente_con_visita",
    "n_direct_contacts": "n_contactos_directos",
    "pct_direct_contact": "pct_contacto_directo",
    "avg_direct_contacts_per_client": "avg_contactos_directos_x_cliente",
    "n_effective_contacts": "n_contactos_efectivos",
    "pct_effective_contact": "pct_contacto_efectivo",
    "avg_effective_contacts_per_client": "avg_contactos_efectivos_x_cliente",
    "collected_total": "cobranza_total",
    "required_payment_total": "pago_requerido_total",
    "efficiency": "eficiencia",
    "n_with_prev": "n_con_prev",
    "avg_arrears": "avg_fisematrasomax",
}
COHORT = {
    "country": "fipais",
    "channel": "ficanal",
    "branch": "fisucursal",
    "folio": "fifolio",
    "period": "fisemana",
    "arrears": "fisematrasomax",
    "segment": "fitipodepto",
    "balance_at_entry": "fnsaldototpenentradalegal",
    "arrears_at_entry": "fisematrasentradalegal",
    "arrears_accumulated": "periodoatrasoacumulado",
    "prev_period": "fisemant",
    "prev_segment": "fideptoant",
    "payment": "fdcrecpago",
    "payment_indicator": "indicadorapago",
    "payment_cumulative": "fdcumsum",
    "total_balance": "saldototalpendiente",
    "principal_balance": "saldocapitalpendiente",
    "entry_period": "fisemanaregistro",
    "periods_since_entry": "fisemdif",
}


def established_names(df: DataFrame, layout: dict[str, str]) -> DataFrame:
    """Rename the columns that have an established name; score columns follow their measure."""
    names = {**layout, **{f"score_{c}_pct": f"score_{n}_pct" for c, n in layout.items()}}
    return df.withColumnsRenamed({c: n for c, n in names.items() if c in df.columns})
