"""The resource catalogue: extras pivoted to columns, joined to one row per resource."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.names import Names
from concordat.operators.dedupe import first_per_key


def pivot_extras(extras: DataFrame, owner: str, fields: Mapping[str, str], trim: bool = True) -> DataFrame:
    """Entity-attribute-value rows to one row per ``owner`` with one column per key.

    ``fields`` maps a key to its output column. A repeated key yields its least value. The
    aggregation combines on the map side, so an owner with very many extras stays cheap.
    """
    key = F.trim("key") if trim else F.col("key")
    value = F.trim("value") if trim else F.col("value")
    picked = [F.min(F.when(key == name, value)).alias(column) for name, column in fields.items()]
    return extras.groupBy(owner).agg(*picked)


def iso(c: Column) -> Column:
    """ISO text of a stamp as written on the clock, with microseconds only when it has some."""
    text = F.replace(c.cast("string"), F.lit(" "), F.lit("T"))
    point = F.instr(text, ".")
    return F.when(point > 0, F.rpad(text, point + 6, F.lit("0"))).otherwise(text)


def last_changed(modified: Column, dataset_modified: Column) -> Column:
    """Later of the two stamps; ``greatest`` skips a missing one."""
    return F.greatest(modified, dataset_modified)


def resource_catalog(
    resource: DataFrame,
    package: DataFrame,
    package_extra: DataFrame,
    organisation: DataFrame,
    organisation_extra: DataFrame,
    user: DataFrame,
    names: Names = Names(),
) -> DataFrame:
    """Active resources of active datasets of organisations that declare a use case."""
    extra = pivot_extras(package_extra, "package_id", {f: f.lower() for f in names.fields})
    org_extra = pivot_extras(organisation_extra, "group_id", {names.siren: names.siren.lower()}, trim=False)
    datasets = package.filter(F.col("state") == "active").select(
        F.col("id").alias("ds_id"),
        F.col("name").alias("ds_name"),
        F.col("title").alias("ds_title"),
        F.col("metadata_created").alias("ds_metadata_created"),
        F.col("metadata_modified").alias("ds_metadata_modified"),
        "owner_org",
        "creator_user_id",
    )
    organisations = organisation.filter("is_organization").select(
        F.col("id").alias("org_id"), F.col("name").alias("org_name"), F.col("title").alias("org_title")
    )
    users = user.select(F.col("id").alias("u_id"), F.col("email").alias("u_email"), F.col("name").alias("u_name"))
    # Datasets meet their small companions first; the many resources are joined once.
    described = (
        datasets.join(extra.filter(F.col(names.use_case.lower()).isNotNull()),
                      datasets["ds_id"] == extra["package_id"])
        .join(organisations, F.col("owner_org") == F.col("org_id"))
        .join(org_extra, F.col("org_id") == F.col("group_id"))
        .join(users, F.col("creator_user_id") == F.col("u_id"))
        .drop("package_id", "owner_org", "creator_user_id")
    )
    return (
        resource.filter(F.col("state") == "active").drop("state")
        .join(described, F.col("package_id") == F.col("ds_id"))
        .withColumn("last_changed", last_changed(F.col("last_modified"), F.col("ds_metadata_modified")))
    )


def latest_by_key(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, so that moved resources leave no duplicate."""
    order = [order] if isinstance(order, str) else list(order)
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order], set(order))
