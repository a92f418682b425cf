import datetime
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from concordat.functions import casts


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame(list(enumerate(inputs)), f"i int, c {kind}")
    return [r.v for r in df.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]


def test_numeric(spark):
    got = values(spark, ["12", " 12 ", "1e3", "1,5", "", None, "abc", "-0.5"], casts.to_numeric)
    assert got == [Decimal(12), Decimal(12), Decimal(1000), None, None, None, None, Decimal("-0.5")]


def test_integer(spark):
    assert values(spark, ["7", "1.5", "x", " 8 "], casts.to_integer) == [7, None, None, 8]


def test_boolean(spark):
    inputs = ["true", "t", "on", "1", "Oui ", "YES", "non", "abc", "", None]
    assert values(spark, inputs, casts.to_boolean) == [True] * 6 + [False] * 3 + [None]
    strict = values(spark, inputs, lambda c: casts.to_boolean(c, strict=True))
    assert strict == [True] * 6 + [False, None, None, None]


def test_boolean_of_number(spark):
    assert values(spark, [0, 1, -2, None], casts.number_to_boolean, "int") == [False, True, True, None]


def test_text(spark):
    assert values(spark, ["a", " a ", "", "  ", None], casts.to_text) == ["a", " a ", None, None, None]


def test_dates(spark):
    day = datetime.date(2021, 1, 2)
    inputs = [
        "2021-01-02T10:00:00.123", "2021/01/02 10:00:00.000", "02/01/2021 00:00:00.000",
        "2021-01-02", " 02/01/2021 ", " ", "xx", "2021-02-30", None,
    ]
    assert values(spark, inputs, casts.to_date) == [day] * 5 + [None] * 4


def test_timestamp_keeps_time(spark):
    got = values(spark, ["2021-01-02T10:00:00.123", "02/01/2021 11:30:00"], casts.to_timestamp)
    assert got == [datetime.datetime(2021, 1, 2, 10, 0, 0, 123000), datetime.datetime(2021, 1, 2, 11, 30)]


@pytest.mark.parametrize(
    "template, text, expected",
    [
        ("YYYY-MM-DD", "2021-02-03", (2021, 2, 3)), ('DD"/"MM"/"YYYY HH24:mi', "03/02/2021 23:59", (2021, 2, 3)),
        ("YYYYMMDD", "20210203", (2021, 2, 3)), ("MM.YYYY", "02.2021", (2021, 2, 1)), ("YYYY", "2021", (2021, 1, 1)),
        ("DD/MM/YY", "03/02/69", (2069, 2, 3)), ("DD/MM/YY", "03/02/70", (1970, 2, 3)),
        ("YYYY-MM-DD", "2021-02-03T24:00", None), ("YYYY-MM-DD", "2021-02-03 10:60", None), ("YYYYMMDD", "2021023", None),
    ],
)
def test_templates(spark, template, text, expected):
    got = values(spark, [text], lambda c: casts.to_date(c, [template]))
    assert got == [datetime.date(*expected) if expected else None]


def test_clock_prefixes(spark):
    inputs = ["2021-01-02T10:05", "2021-01-02 10:05:06", "2021-01-02", "2021-01-02T10:05:06.1234567", "2021-03-28T02:30:00"]
    at = lambda *a: datetime.datetime(2021, *a)
    assert values(spark, inputs, casts.to_timestamp) == [
        at(1, 2, 10, 5), at(1, 2, 10, 5, 6), at(1, 2), at(1, 2, 10, 5, 6, 123456), at(3, 28, 2, 30)]


def test_uuid_matches_the_standard_library(spark):
    ns = casts.namespace_uuid("perimetre.test")
    names = ["", "a", "canalisations_123_1", "été à Nîmes", "日本", "x" * 200, None] + [f"n{i}" for i in range(50)]
    got = values(spark, names, lambda c: casts.uuid_v5(ns, c))
    assert got == [None if n is None else str(uuid.uuid5(ns, n)) for n in names]


def test_fold_text(spark):
    assert values(spark, ["Nîmes", "L'Haÿ-les-Roses", "Œuilly", None], casts.fold_text) == [
        "NIMES", "L'HAY-LES-ROSES", "OEUILLY", None]
