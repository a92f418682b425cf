"""Indicators over the nodes (models, seeds, tests) of a transformation project."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds of node that are counted.
TAGS = (
    "definition", "dictionary", "normalization", "sample", "expected", "unification", "enriched", "indicators",
)
# Kinds whose nodes belong to a data type named after the use case.
TYPED_TAGS = ("definition", "normalization", "sample", "expected", "unification", "enriched")


def node_indicators(
    nodes: DataFrame, use_case: str, tags: Sequence[str] = TAGS, typed_tags: Sequence[str] = TYPED_TAGS
) -> DataFrame:
    """One 0/1 column per tag, set by the node's name or its tag list, and the node's data type."""
    flags = {
        tag: F.when(
            F.col("name").rlike(f"^.+_{re.escape(tag)}")
            | F.coalesce(F.array_contains("tags", tag), F.lit(False)),
            1,
        ).otherwise(0)
        for tag in tags
    }
    pattern = f"{re.escape(use_case)}_([^_]*)"
    flagged = nodes.withColumns(flags)
    is_typed = F.greatest(*[F.col(t) for t in typed_tags if t in tags]) == 1
    node_type = F.when(is_typed & F.col("name").rlike(pattern), F.regexp_extract("name", pattern, 1))
    return flagged.select("name", F.lit(use_case).alias("use_case"), node_type.alias("type"), *tags, "node_json")


def node_indicators_by_type(indicators: DataFrame, tags: Sequence[str] = TAGS) -> DataFrame:
    return indicators.groupBy("use_case", "type").agg(*[F.sum(t).alias(t) for t in tags])
