"""Contact codes: (visit code, result code) to contact type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.visits import flatten_codes

# Contact type -> visit code -> result codes.
CONTACT_CODES = {
    "contacto_directo": {
        1: [0],
        4: [1],
        9: [1, 2, 3, 7, 8, 9, 10, 12, 15],
        11: [4, 5, 10],
        26: [0],
        38: [2, 3, 4, 5, 7, 8],
        57: [0, 1],
        61: [1, 2],
        105: [1, 2, 4, 10, 11, 12, 13, 14, 15, 16],
        113: [1, 2],
        170: [1, 2, 3, 11],
    },
    "contacto_indirecto": {
        1: [5, 7],
        3: [1, 3, 5, 7, 8],
        7: [1, 2, 5],
        8: [1, 3, 7, 8, 11, 15, 16],
        9: [4, 5, 6],
        27: [6, 4, 7],
        32: [7, 8],
        170: [6, 8, 9, 12],
    },
    "sin_contacto": {
        3: [2],
        7: [6, 7],
        8: [2],
        30: [1, 2, 3, 4],
        39: [2, 3],
        170: [5, 7, 10],
    },
}


def code_map(spark: SparkSession, codes: Mapping[str, Mapping[str, Sequence[int]]] = CONTACT_CODES) -> DataFrame:
    """The code map as rows ``visit_code, result_code, contact_type``.

    An inline table: the planner knows its exact size when it chooses the join.
    """
    flat = flatten_codes(codes)
    if not flat:
        return spark.createDataFrame([], "visit_code int, result_code int, contact_type string")
    values = ", ".join(f"({v}, {r}, :t{i})" for i, (v, r, _) in enumerate(flat))
    texts = {f"t{i}": t for i, (_, _, t) in enumerate(flat)}
    return spark.sql(f"SELECT * FROM VALUES {values} AS codes(visit_code, result_code, contact_type)", args=texts)


def code_map_from_json(spark: SparkSession, path: str) -> DataFrame:
    """The code map of a JSON file ``{type: {visit code: [result codes]}}``.

    Configuration of a few hundred entries, read through Spark so that any
    storage Spark knows works.
    """
    import json

    text = spark.read.text(path, wholetext=True).first()[0]
    return code_map(spark, json.loads(text))
