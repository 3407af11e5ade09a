"""Column expressions for area keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where a feature's properties may hold the area key, in order of preference.
KEY_PATHS = ("$.externalKey", "$.label", "$.options.cad_num")


def area_key(properties: Column, paths: tuple[str, ...] = KEY_PATHS) -> Column:
    """First non-empty key among the given JSON paths; NULL if none has one."""
    return F.coalesce(*[F.nullif(F.get_json_object(properties, path), F.lit("")) for path in paths])


def key_suffix(key: Column) -> Column:
    """Text after the last colon; empty if the key is missing."""
    return F.coalesce(F.substring_index(key, ":", -1), F.lit(""))
