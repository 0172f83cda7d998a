"""Entity keys: four id parts flattened to ``"a-b-c-d"`` and back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEPARATOR = "-"


def composite_key(*parts: str | Column, require_all_parts: bool = False) -> Column:
    """Join the key parts with ``-``.

    ``concat_ws`` skips NULL parts, so the key itself is never NULL and
    ``(NULL, a, NULL, b)`` collides with ``(a, b)``. ``require_all_parts=True``
    returns NULL instead as soon as one part is missing.
    """
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    key = F.concat_ws(SEPARATOR, *[c.cast("string") for c in columns])
    if not require_all_parts:
        return key
    complete = columns[0].isNotNull()
    for column in columns[1:]:
        complete = complete & column.isNotNull()
    return F.when(complete, key)


def key_part(key: str | Column, position: int, data_type: str) -> Column:
    """One typed part of a flattened key; NULL when absent or not a number."""
    return F.get(F.split(key, SEPARATOR), position).try_cast(data_type)


def key_parts(key: str | Column, names: tuple[str, str, str, str] = ("country", "channel", "branch", "folio")) -> list[Column]:
    """The four typed parts (int, int, long, long) of a flattened key."""
    types = ("int", "int", "long", "long")
    return [key_part(key, i, t).alias(n) for i, (n, t) in enumerate(zip(names, types))]
