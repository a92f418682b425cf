"""Shared Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])

# parts -> rings -> points. A point or a line is one part with one ring.
PARTS = T.ArrayType(T.ArrayType(T.ArrayType(POINT)))

GEOMETRY = T.StructType(
    [
        T.StructField("srid", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("parts", PARTS),
    ]
)

DECIMAL = T.DecimalType(38, 10)


def is_geometry(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StructType) and data_type.fieldNames() == GEOMETRY.fieldNames()


def is_number(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def is_timestamp(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.TimestampType, T.TimestampNTZType))


def is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.CharType, T.VarcharType))
