"""Field visits: contact type, on-site validity and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.amounts import clamp_at_zero, flag
from ..functions.geo import great_circle_m
from ..functions.periods import minutes_between

# Contact types and defaults.
DIRECT_CONTACT = "contacto_directo"
NO_INFO = "sin_info"
MISSING_COORDINATE = "0.0"
ON_SITE_METRES = 100
SKIPPED_VISIT_CODE = 50
ACTION_CODES_FROM = 800
VISIT_CODES_BELOW = 200

# Fixed values: (visit code, result codes) that make a contact effective;
# None stands for any result.
EFFECTIVE_CONTACTS = ((1, None), (9, 3), (11, 4), (32, 7))

COORDINATES = ("agent_lat", "agent_lon", "client_lat", "client_lon")


def is_field_visit() -> Column:
    """Codes of visits made at the client's place."""
    return (F.col("visit_code") < VISIT_CODES_BELOW) & (F.col("visit_code") != SKIPPED_VISIT_CODE)


def with_contact_type(visits: DataFrame, code_map: DataFrame) -> DataFrame:
    """Add ``contact_type`` by joining (visit code, result code) to the code map.

    ``code_map`` has one row per code pair (see ``sources.codes``), so the join
    never multiplies rows, and its size is known to the planner, which
    broadcasts it below its threshold. Unknown pairs get ``sin_info``.
    """
    types = code_map.select("visit_code", "result_code", F.col("contact_type").alias("_type"))
    return (
        visits.join(types, on=["visit_code", "result_code"], how="left")
        .withColumn("contact_type", F.coalesce("_type", F.lit(NO_INFO)))
        .drop("_type")
    )


def with_geo_measures(visits: DataFrame, clamp: bool = True) -> DataFrame:
    """Drop visits without coordinates, add ``dist_m`` and ``minutes``."""
    located = visits
    for c in COORDINATES:
        located = located.where(F.col(c) != MISSING_COORDINATE)
    return located.withColumns(
        {
            "dist_m": great_circle_m("agent_lat", "agent_lon", "client_lat", "client_lon", clamp),
            "minutes": minutes_between("start_ms", "end_ms"),
        }
    )


def valid_on_site(visits: DataFrame, min_minutes: float = 1, clamp: bool = True) -> DataFrame:
    """Visits within 100 m of the client that lasted long enough."""
    on_site = (F.col("dist_m") < ON_SITE_METRES) & (F.col("minutes") >= min_minutes)
    return with_geo_measures(visits, clamp).where(on_site)


def with_contact_flags(visits: DataFrame) -> DataFrame:
    """Add the direct-contact and effective-contact flags."""
    effective = F.lit(False)
    for visit_code, result_code in EFFECTIVE_CONTACTS:
        hit = F.col("visit_code") == visit_code
        if result_code is not None:
            hit = hit & (F.col("result_code") == result_code)
        effective = effective | hit
    return visits.withColumns(
        {
            "direct_contact": flag(F.col("contact_type") == DIRECT_CONTACT),
            "effective_contact": flag(effective),
        }
    )


def visit_counts(visits: DataFrame, start_period: int, codes_from: int = ACTION_CODES_FROM) -> DataFrame:
    """Visits per entity and period with a code of ``codes_from`` or more."""
    chosen = (F.col("period") >= start_period) & (F.col("visit_code") >= codes_from)
    return visits.where(chosen).groupBy("entity_id", "period").agg(F.count(F.lit(1)).alias("n_visits"))


def typed_contacts(visits: DataFrame, code_map: DataFrame, min_minutes: float, clamp: bool = True) -> DataFrame:
    """Valid field visits with contact type and flags."""
    valid = valid_on_site(visits.where(is_field_visit()), min_minutes, clamp)
    return with_contact_flags(with_contact_type(valid, code_map))


def contacts_by_entity_period(visits: DataFrame, code_map: DataFrame, min_minutes: float, clamp: bool = True) -> DataFrame:
    """Valid field visits per entity and period: visits, direct and effective contacts."""
    return (
        typed_contacts(visits, code_map, min_minutes, clamp)
        .groupBy("entity_id", "period")
        .agg(
            F.count(F.lit(1)).alias("n_visits"),
            F.sum("direct_contact").alias("n_direct_contacts"),
            F.sum("effective_contact").alias("n_effective_contacts"),
        )
    )


def collected_by_entity_period(payments: DataFrame) -> DataFrame:
    """Capital plus interest per entity and period, negative parts as 0."""
    return payments.groupBy("entity_id", "period").agg(
        (F.sum(clamp_at_zero("capital")) + F.sum(clamp_at_zero("interest"))).alias("collected")
    )


def flatten_codes(codes: Mapping[str, Mapping[str, Sequence[int]]]) -> list[tuple[int, int, str]]:
    """(visit code, result code, type) rows; a pair named twice keeps its last type."""
    pairs: dict[tuple[int, int], str] = {}
    for contact_type, by_visit in codes.items():
        for visit_code, results in by_visit.items():
            pairs.update({(int(visit_code), int(r)): contact_type for r in results})
    return [(v, r, t) for (v, r), t in pairs.items()]
