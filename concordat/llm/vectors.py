"""Whole-number vectors, and a set of queries that meets all of them in tiles of bounded size.

A tile is one block of rows together with every query. Blocks are dealt out by place in the stored table, so copies of
one vector, or rows of one label, spread evenly, and there are as many as cores unless a block would hold more than
COMPONENTS numbers. Queries come to a block in batches behind its rows: a task holds one block and one batch.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.shared import stored

#: Numbers in a block of vectors.
COMPONENTS = 1 << 23
#: Rows that are worth a block of their own.
FEWEST = 1024
_LONG = (-(1 << 63), (1 << 63) - 1)


@dataclass(frozen=True)
class Shape:
    """Rows, the longest vector and the largest size of a component."""

    count: int
    dims: int
    peak: float

    @property
    def exact(self) -> np.dtype:
        """A type in which every sum of products is exact: floats while whole numbers fit them, else Python's integers."""
        most = self.dims * self.peak * self.peak
        return np.dtype(np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object)

    def tiles(self, cores: int) -> int:
        return max(1, math.ceil(self.count * self.dims / COMPONENTS), min(cores, math.ceil(self.count / FEWEST)))


def usable(vector: Column) -> Column:
    """The vector is there and all its components are finite numbers."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))


def whole_vectors(vectors: DataFrame, scale: float, id_col: str, vector_col: str, label: Column | None = None) -> tuple[DataFrame, Shape]:
    """(stored rows of id, label, dims and q, their shape): q holds floor(scale * x) of every component x as a double.

    Rows without an id, without a vector or with a component that is null or not finite are left out.
    """
    label = F.lit(None) if label is None else label
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), label.cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(2)
            with np.errstate(over="ignore"):
                flat = np.clip(np.floor(scale * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)), -np.finfo(float).max, np.finfo(float).max)
            ends = v.offsets.to_numpy() - v.offsets[0].as_py()
            packed, dims, peaks = [], np.diff(ends), []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                own = flat[a:b]
                peaks.append(float(np.abs(own).max(initial=0)))
                packed.append(own.astype("<i2" if peaks[-1] < 1 << 15 else "<i4" if peaks[-1] < 1 << 31 else "<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(peaks, pa.float64()), pa.array(packed, pa.binary())],
                ["id", "label", "dims", "peak", "q"])

    out = stored(rows.mapInArrow(pack, "id bigint, label string, dims int, peak double, q binary"), "whole-vectors")
    count, dims, peak = out.agg(F.count("*"), F.max("dims"), F.max("peak")).first()
    return out.drop("peak"), Shape(count, dims or 0, peak or 0.0)


def matrix(dims: pa.Array, packed: pa.Array, shape: Shape) -> np.ndarray:
    """Vectors by row; a shorter vector counts as 0 in the components that it lacks."""
    out = np.zeros((len(dims), shape.dims), shape.exact)
    for row, size, raw in zip(out, dims.to_pylist(), packed.to_pylist(), strict=True):
        if size:
            own = np.frombuffer(raw, {2: "<i2", 4: "<i4", 8: "<f8"}[len(raw) // size])
            row[:size] = own if out.dtype != object else [int(x) for x in own]
    return out


def longs(scores: np.ndarray) -> np.ndarray:
    """Exact scores as 64-bit integers, held at their ends beyond them."""
    if scores.dtype == object:
        scores = np.array([min(max(s, _LONG[0]), _LONG[1]) for s in scores.ravel().tolist()], object).reshape(scores.shape)
    return scores.astype(np.int64)


def first_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest of some 64-bit scores, in order, ties to smaller ids."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], ~scores[at]))][:k]


@dataclass
class Block:
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray


def in_tiles(
    rows: DataFrame, queries: DataFrame, shape: Shape, start: Callable[[Block], Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch | None]], schema: str,
) -> DataFrame:
    """What start(block) returns for every batch of queries, for every block of the rows.

    Queries have the columns of rows (id, label, dims, q) and any others; the batch holds all of them, and the matrix its
    vectors. Both tables have to be stored ones, as rows are told by their places.
    """
    tiles = shape.tiles(rows.sparkSession.sparkContext.defaultParallelism)
    own = [c for c in queries.columns if c not in rows.columns]
    held = rows.select(F.pmod(F.monotonically_increasing_id(), F.lit(tiles)).cast("int").alias("tile"), F.lit(False).alias("asks"), "id", "label", "dims", "q",
                       *[F.lit(None).cast(queries.schema[c].dataType).alias(c) for c in own])
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), F.lit(True).alias("asks"), "id", "label", "dims", "q", *own)
    dealt = held.unionByName(asked).repartitionById(tiles, "tile").sortWithinPartitions("tile", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        ask = None
        for batch in batches:
            if not batch.num_rows:
                continue
            asks = batch.column(1).to_numpy(zero_copy_only=False)
            cut = int(np.argmax(asks)) if asks.any() else len(asks)  # a partition is one tile
            if cut:
                some = batch.slice(0, cut)
                parts.append((some.column(2).to_numpy(), some.column(3).to_numpy(zero_copy_only=False), matrix(some.column(4), some.column(5), shape)))
            if cut < len(asks) and parts:
                if ask is None:
                    ask = start(Block(*(np.concatenate(x) for x in zip(*parts, strict=True))))
                some = batch.slice(cut)
                if (found := ask(some, matrix(some.column(4), some.column(5), shape))) is not None:
                    yield found

    return dealt.mapInArrow(run, schema)
