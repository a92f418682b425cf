"""Every registered query against its SQL on the smallest data set."""

import math
import os
from decimal import Decimal

import pytest

import __spark_entry__ as entry
from concordat.plans.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the generated tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{DIR}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, duck, name):
    done = entry.queries()[name](spark, DIR)
    columns = sorted(done.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in done.collect())
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    wanted = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert len(got) == len(wanted)
    assert got == wanted
