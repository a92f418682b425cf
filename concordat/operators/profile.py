"""Column profiles of whole schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions.casts import to_numeric
from concordat.operators.union import fold_union

# Shares above which a column is recommended as not null or unique.
NOT_NULL_SHARE, UNIQUE_SHARE = 0.9, 0.9
#: Sizes of the sketches of a column, and what they may be wrong by: the distinct count has a relative standard
#: error of 1.04 / sqrt(2 ** HLL_BITS), quartiles miss their rank by RANK_ERROR of the numbers at most (with 99 %
#: confidence), and with TRACKED values tracked a count of a value may be too high by FREQUENT_ERROR of the rows.
HLL_BITS, KLL_SIZE, TRACKED, TOP = 14, 400, 1000, 20
DISTINCT_ERROR, RANK_ERROR, FREQUENT_ERROR = 1.04 / 2 ** (HLL_BITS / 2), 0.01, 3.5 / 2048


def _text(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(c) if nested else c.cast("string")


def unpivot(df: DataFrame, first: int = 0) -> DataFrame:
    """``(column_number, column_value)``, values as text, of every column.

    Numbers count from ``first``; unlike names they group and sort as plain integers.
    """
    cells = [c for i, f in enumerate(df.schema) for c in (F.lit(first + i), _text(f))]
    return df.select(F.stack(F.lit(len(df.columns)), *cells).alias("column_number", "column_value"))


def _profiled(df: DataFrame) -> DataFrame:
    """Only named columns without a dash in their name are profiled."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c and "-" not in c])


def column_metadata(spark: SparkSession, tables: Mapping[str, DataFrame], catalog: str, schema: str) -> DataFrame:
    described = [(table, f, i) for table, df in tables.items() for i, f in enumerate(df.schema, 1)]
    profiled = [d for d in described if d[1].name and "-" not in d[1].name]
    rows = [
        (n, catalog, schema, table, f.name, i, "YES" if f.nullable else "NO", f.dataType.simpleString())
        for n, (table, f, i) in enumerate(profiled)
    ]
    return spark.createDataFrame(
        rows,
        "column_number int, table_catalog string, table_schema string, table_name string, column_name string, "
        "ordinal_position int, is_nullable string, data_type string",
    )


def profile(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    catalog: str = "spark_catalog",
    schema: str = "default",
    not_null_share: float = NOT_NULL_SHARE,
    unique_share: float = UNIQUE_SHARE,
    approx: bool = False,
) -> DataFrame:
    """Counts, distinct values, extremes, mean, most frequent value and lengths per column.

    Equal values are counted first, partially in each map task, and columns are summed up from
    these counts. So no task ever holds the distinct values of a column, and exact distinct
    counts and the most frequent value cost one shuffle of distinct values. The broadcast side has
    one row per column.

    With ``approx`` no values are shuffled, only one row of sketches per task: see ``profile_sketches``.
    """
    if approx:
        return profile_from_sketches(profile_sketches(spark, tables, catalog, schema), not_null_share, unique_share)
    frames, first = [], 0
    for df in map(_profiled, tables.values()):
        if df.columns:
            frames.append(unpivot(df, first))
            first += len(df.columns)
    values = fold_union(frames).groupBy("column_number", "column_value").agg(F.count(F.lit(1)).alias("n"))
    value, n = F.col("column_value"), F.col("n")
    number = to_numeric(value).cast("double")
    length = F.length(value)
    stats = values.groupBy("column_number").agg(
        F.sum(n).alias("table_rows"),
        F.count(value).alias("count_distinct_values"),
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).cast("bigint").alias("count_nulls"),
        F.coalesce(F.sum(F.when(value.isNotNull(), n)), F.lit(0)).cast("bigint").alias("count_not_nulls"),
        F.min(value).alias("_min_value"),
        F.max(value).alias("_max_value"),
        F.try_divide(F.sum(number * n), F.sum(F.when(number.isNotNull(), n))).alias("_avg_value"),
        # The greatest of equally frequent values.
        F.max_by(value, F.when(value.isNotNull(), F.struct(n, value))).alias("_most_frequent_value"),
        F.min(length).alias("_min_length"),
        F.max(length).alias("_max_length"),
        F.round(F.try_divide(F.sum(length * n), F.sum(F.when(value.isNotNull(), n)))).alias("_avr_length"),
    )
    metadata = column_metadata(spark, tables, catalog, schema)
    return _report(stats.join(F.broadcast(metadata), "column_number"), not_null_share, unique_share)


def _report(stats: DataFrame, not_null_share: float, unique_share: float, *more: str) -> DataFrame:
    """What the counts of every column say, beside its metadata."""
    shares = stats.withColumns(
        {
            "pct_not_null": F.col("count_not_nulls") / F.col("table_rows"),
            "pct_unique": F.col("count_distinct_values") / F.col("table_rows"),
        }
    )
    return shares.select(
        "table_catalog", "table_schema", "table_name", "column_name",
        F.coalesce(F.col("is_nullable") != "YES", F.lit(True)).alias("is_not_nullable_column"),
        (F.col("pct_not_null") > not_null_share).alias("is_recommended_not_nullable_column"),
        "count_nulls", "count_not_nulls", "pct_not_null", "table_rows", "count_distinct_values", "pct_unique",
        (F.col("pct_unique") >= unique_share).alias("is_recommended_unique_column"),
        "ordinal_position", "data_type",
        "_min_value", "_max_value", "_avg_value", "_most_frequent_value",
        "_min_length", "_max_length", "_avr_length", *more,
    )


_COLUMN = ["table_catalog", "table_schema", "table_name", "column_name", "ordinal_position", "data_type"]


def _sketch(value: Column, name: str) -> list[Column]:
    number, length = to_numeric(value).cast("double"), F.length(value)
    return [
        F.count(F.lit(1)).alias("table_rows"), F.count(value).alias("count_not_nulls"),
        F.min(value).alias("_min_value"), F.max(value).alias("_max_value"),
        F.sum(number).alias("number_sum"), F.count(number).alias("number_count"),
        F.min(length).alias("_min_length"), F.max(length).alias("_max_length"), F.sum(length).alias("length_sum"),
        F.hll_sketch_agg(value, HLL_BITS).alias("distinct"), F.kll_sketch_agg_double(number, KLL_SIZE).alias("quantiles"),
        F.expr(f"approx_top_k_accumulate({name}, {TRACKED}) FILTER (WHERE {name} IS NOT NULL)").alias("frequent"),
    ]


def _merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    least, greatest = ["_min_value", "_min_length"], ["_max_value", "_max_length"]
    sums = ["table_rows", "count_not_nulls", "number_sum", "number_count", "length_sum"]
    return sketches.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in least], *[F.max(c).alias(c) for c in greatest],
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"))


def profile_sketches(
    spark: SparkSession, tables: Mapping[str, DataFrame], catalog: str = "spark_catalog", schema: str = "default"
) -> DataFrame:
    """One row per column of the tables: exact counts, extremes and sums, and sketches of its values.

    Sketches can be stored, and those of parts (days, owners) merge into those of the whole. Cells are
    not turned into rows: every task reduces its part of a table to one row, which holds the sketches
    of all columns. These rows are merged in as many shares as there are shuffle partitions, then by column.
    An empty table has no rows, as in the exact profile.
    """
    shares, frames, first = int(spark.conf.get("spark.sql.shuffle.partitions")), [], 0
    for df in map(_profiled, tables.values()):
        if not df.columns:
            continue
        names = [f"v{i}" for i in range(len(df.columns))]
        cells = df.select((F.spark_partition_id() % shares).alias("share"), *[_text(f).alias(n) for f, n in zip(df.schema, names)])
        wide = cells.groupBy("share").agg(*[F.struct(*_sketch(F.col(n), n)).alias(n) for n in names])
        stacked = [c for i, n in enumerate(names) for c in (F.lit(first + i), F.col(n))]
        frames.append(wide.select(F.stack(F.lit(len(names)), *stacked).alias("column_number", "s")).select("column_number", "s.*"))
        first += len(names)
    metadata = column_metadata(spark, tables, catalog, schema)
    return _merged(fold_union(frames), ["column_number"]).join(F.broadcast(metadata), "column_number").drop("column_number")


def merge_sketches(parts: Sequence[DataFrame]) -> DataFrame:
    """The sketches of a whole from those of its parts; a column is nullable if it is so in one part."""
    rows = reduce(DataFrame.unionByName, parts)
    nullable = rows.groupBy(*_COLUMN).agg(F.max("is_nullable").alias("is_nullable"))
    return _merged(rows, _COLUMN).join(nullable, _COLUMN)


def profile_from_sketches(
    sketches: DataFrame, not_null_share: float = NOT_NULL_SHARE, unique_share: float = UNIQUE_SHARE
) -> DataFrame:
    """The profile that sketches tell, with quartiles of the numbers (``_quartiles``).

    All is exact but the distinct count, the quartiles and the most frequent value (see the error bounds above).
    The value named as most frequent falls short of the greatest count by that bound at most; it may be NULL where
    no count exceeds the bound. Of equally frequent ones among the first ``TOP`` it is the greatest.
    """
    top = F.expr(f"approx_top_k_estimate(frequent, {TOP})")
    best = F.array_max(F.transform(top, lambda x: F.struct(x["count"].alias("n"), x["item"].alias("item"))))
    quartiles = F.kll_sketch_get_quantile_double("quantiles", F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)]))
    stats = sketches.withColumns({
        "count_nulls": F.col("table_rows") - F.col("count_not_nulls"),
        "count_distinct_values": F.least(F.hll_sketch_estimate("distinct"), F.col("count_not_nulls")),
        "_avg_value": F.try_divide("number_sum", F.col("number_count")),
        "_avr_length": F.round(F.try_divide("length_sum", F.col("count_not_nulls"))),
        "_most_frequent": best,
        "_quartiles": F.when(F.col("number_count") > 0, quartiles),
    }).withColumns({"_most_frequent_value": F.col("_most_frequent.item"), "_most_frequent_count": F.col("_most_frequent.n")})
    return _report(stats, not_null_share, unique_share, "_most_frequent_count", "_quartiles")
