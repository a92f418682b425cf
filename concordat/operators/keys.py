"""Generic keys: where a row came from, its overall id and its reproducible UUID."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions.casts import namespace_uuid, uuid_v5
from concordat.names import Names


def add_generic_fields(
    df: DataFrame, prefix: str, namespace: str, src_priority: str | None = None, names: Names = Names()
) -> DataFrame:
    """Add the generic key columns to a table that has ``<prefix>src_id`` and provenance.

    All columns come from one projection, so nothing is shuffled. A priority of 0 is the
    highest, then 10, 100 and so on.
    """
    src_name = F.concat(F.col(names.source), F.lit("_"), F.col("data_owner_id"))
    overall = F.concat(src_name, F.lit("_"), F.col(f"`{prefix}src_id`").cast("string"))
    priority = src_name if src_priority is None else F.concat(F.lit(f"{src_priority}_"), src_name)
    return df.withColumns(
        {
            f"{prefix}src_kind": F.col(names.source),
            f"{prefix}src_name": src_name,
            f"{prefix}src_table": F.col("import_table"),
            f"{prefix}src_priority": priority,
            f"{prefix}id": overall,
            f"{prefix}uuid": uuid_v5(namespace_uuid(namespace), overall),
        }
    )


def translate_perimeters(
    parsed: DataFrame,
    prefix: str,
    namespace: str,
    src_priority: str | None = None,
    src_id: str | None = None,
    limit: int = 0,
    names: Names = Names(),
) -> DataFrame:
    """Perimeters with generic keys. ``src_id`` names the column to use; the default is the constant 1."""
    rows = parsed.limit(limit) if limit > 0 else parsed
    key = F.lit(1) if src_id is None else F.col(src_id)
    return add_generic_fields(rows.withColumn(f"{prefix}src_id", key), prefix, namespace, src_priority, names)
