"""Deduplication: one row survives per group of equal ids."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"


def _names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type)
    return not isinstance(data_type, (T.MapType, T.VariantType))


_SUFFIX = re.compile(r"(?:\s+(asc|desc))?(?:\s+nulls\s+(first|last))?\s*$", re.IGNORECASE)


def _split(order_by: str) -> list[str]:
    """Items of the text, cut at commas outside parentheses and quotes."""
    items, depth, quote, start = [], 0, "", 0
    for at, c in enumerate(order_by):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "," and not depth:
            items.append(order_by[start:at])
            start = at + 1
    return [x.strip() for x in [*items, order_by[start:]] if x.strip()]


def _parts(item: str) -> tuple[str, bool, bool]:
    """(expression, descending, NULLs first)."""
    found = _SUFFIX.search(item)
    descending = (found[1] or "").lower() == "desc"
    nulls = (found[2] or "").lower()
    return item[: found.start()].strip(), descending, nulls == "first" or (descending and nulls != "last")


def parse_order(order_by: str | Sequence[str | Column] | None) -> list[Column]:
    """Sort columns from ``"coalesce(a, b) desc, c"``-like text, with the database's placing of NULLs.

    Ascending puts NULLs last and descending puts them first, unless the text says otherwise.
    """
    if order_by is None:
        return []
    items = _split(order_by) if isinstance(order_by, str) else order_by
    result = []
    for item in items:
        if isinstance(item, Column):
            result.append(item)
            continue
        text, descending, nulls_first = _parts(item)
        column = F.expr(text)
        if descending:
            result.append(column.desc_nulls_first() if nulls_first else column.desc_nulls_last())
        else:
            result.append(column.asc_nulls_first() if nulls_first else column.asc_nulls_last())
    return result


def _ordered(order_by: str | Sequence[str | Column] | None) -> set[str]:
    items = _split(order_by) if isinstance(order_by, str) else order_by or []
    return {_parts(item)[0].strip("`") for item in items if isinstance(item, str)}


def first_per_key(
    df: DataFrame, keys: str | Sequence[str], order: Sequence[Column], ordered: set[str] = frozenset()
) -> DataFrame:
    """Keep one row per key. Rows that tie on ``order`` are told apart by their other columns,
    save those that ``order`` holds already (``ordered``).

    ``row_number() = 1`` is a pattern Spark limits per group before the shuffle, so each map
    task sends at most one row per key, however many rows a hot key or the NULL group has.
    """
    keys = _names(keys)
    ties = [
        F.col(f"`{f.name}`").asc_nulls_last()
        for f in df.schema
        if f.name not in keys and f.name not in ordered and _orderable(f.dataType)
    ]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedupe(
    df: DataFrame,
    ids: str | Sequence[str],
    order_by: str | Sequence[str | Column] | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """``DISTINCT ON (ids)``: the first row per ids by ``order_by``. NULL ids form one group."""
    source = df if where is None else df.filter(where)
    return first_per_key(source, ids, parse_order(order_by), _ordered(order_by))


def dedupe_agg(
    df: DataFrame,
    ids: str | Sequence[str],
    order_by: str,
    where: str | Column | None = None,
) -> DataFrame:
    """``dedupe`` as one aggregation of whole rows. Each map task sorts its rows, then sends one per key.

    All sort columns must run in one direction, since the row is picked by one least or greatest
    struct. Ties on ``order_by`` go by the other columns in that same direction, so name a
    total order to get exactly the rows of ``dedupe``.
    """
    ids = _names(ids)
    source = df if where is None else df.filter(where)
    parts = [_parts(item) for item in _split(order_by)]
    directions = {"desc" if descending else "asc" for _, descending, _ in parts}
    if len(directions) > 1:
        raise ValueError("dedupe_agg needs one sort direction; use dedupe for mixed ones")
    # With the NULL flag first, an ascending pick leaves NULLs last and a descending one takes them first.
    named = _ordered(order_by)
    ties = [f.name for f in df.schema if f.name not in ids and f.name not in named and _orderable(f.dataType)]
    keys = [F.expr(p[0]) for p in parts] + [F.col(f"`{c}`") for c in ties]
    rank = [f for c in keys for f in (c.isNull(), c)]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    pick = F.max_by if directions == {"desc"} else F.min_by
    best = pick(row, F.struct(*[f.alias(f"r{i}") for i, f in enumerate(rank)]))
    return source.groupBy(*ids).agg(best.alias("__best")).select("__best.*")
