"""Indicators over facts joined to reference data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_and_sum_by(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    by: Sequence[str],
    counted: str,
    summed: str,
    count_name: str,
    sum_name: str,
) -> DataFrame:
    """Non-NULL count and sum of facts by columns of both sides of an inner join.

    Facts are first reduced per join key and own grouping columns, with partial aggregation in
    each map task, so the join moves groups and not facts and a hot key is a handful of rows.
    """
    own = [c for c in by if c in facts.columns]
    reduced = facts.groupBy(*dict.fromkeys([fact_key, *own])).agg(
        F.count(counted).alias("__count"), F.sum(summed).alias("__sum")
    )
    joined = reduced.join(lookup, F.col(fact_key) == F.col(lookup_key))
    return joined.groupBy(*by).agg(F.sum("__count").alias(count_name), F.sum("__sum").alias(sum_name))


def light_points_by_commune(points: DataFrame, population: DataFrame) -> DataFrame:
    """Light points and their power per manager and commune, beside the commune's population."""
    inhabitants = population.select("Code", "Population municipale 2019")
    return count_and_sum_by(
        points, inhabitants, "insee", "Code",
        by=["gestionnaire_title", "est_dans_commune_com_nom", "Population municipale 2019"],
        counted="reference", summed="puissance",
        count_name="nombre_point_lumineux", sum_name="puissance_totale",
    )
