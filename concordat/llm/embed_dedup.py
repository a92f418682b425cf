"""Near-duplicate embeddings by randomised-rotation binary codes.

A vector is rotated at random and kept as its signs with one correction factor. From the signs of one vector and the
rotated other follows an unbiased estimate of their cosine with a confidence bound, and only pairs whose bound reaches
the threshold are computed exactly. Which pairs meet is decided by further sign bits: as many tables of as many bits as
the wanted recall asks for at the threshold, so closer pairs are found more surely. Crowded buckets are cut into blocks
that meet pairwise in tiles of bounded size. A pair is counted in the first table in which it meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.shared import components, groups, stored

#: Vectors of a block; a tile holds two blocks.
BLOCK = 1024
#: Bucket size that the number of bits aims at.
BUCKET = 64


@lru_cache(maxsize=64)
def rotation(size: int, number: int) -> np.ndarray:
    """A random rotation, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([size, number]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def tables_for(count: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits, tables) for so many vectors of a label, such that a pair at the threshold meets with the wanted recall."""
    bits = min(24, max(4, math.ceil(math.log2(max(1, count / BUCKET)))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def bucket_keys(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Row by table: the signs after rotations 1, 2, ..., read as numbers of so many bits."""
    size = unit.shape[1]
    need = bits * tables
    signs = np.concatenate([unit @ rotation(size, 1 + i) > 0 for i in range(-(-need // size))], axis=1)[:, :need]
    return (signs.reshape(len(unit), tables, bits) << np.arange(bits)).sum(-1).astype(np.int32)


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed signs, correction factor): the factor is the cosine between a rotated vector and its signs."""
    turned = unit @ rotation(unit.shape[1], 0)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / math.sqrt(unit.shape[1])


def links_in_tile(
    vectors: np.ndarray, codes: np.ndarray, factors: np.ndarray, side: np.ndarray, keys: np.ndarray, table: int, threshold: float, deviations: float,
) -> list[tuple[int, np.ndarray]]:
    """(i, those j > i linked to it) for pairs whose first common table is this one. Two sides: only pairs across."""
    size = vectors.shape[1]
    norms = np.sqrt((vectors * vectors).sum(1))
    unit = vectors / norms[:, None]
    turned = (unit @ rotation(size, 0)).astype(np.float32)
    signs = (np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1) / np.float32(math.sqrt(size))
    margin = deviations * np.sqrt(np.maximum(1 - factors**2, 0) / factors**2 / max(size - 1, 1)) + 1e-4
    across = side.min() != side.max()
    out = []
    for at in range(0, len(vectors), 256):
        estimate = signs[at : at + 256] @ turned.T / factors[at : at + 256, None].astype(np.float32)
        likely = estimate + margin[at : at + 256, None] >= threshold
        for row in range(len(likely)):
            i = at + row
            near = i + 1 + np.flatnonzero(likely[row, i + 1 :])
            if across:
                near = near[side[near] != side[i]]
            if len(near):
                near = near[(vectors[near] @ vectors[i]) / (norms[near] * norms[i]) >= threshold]
            if len(near) and table:
                near = near[~(keys[near, :table] == keys[i, :table]).any(1)]
            if len(near):
                out.append((i, near))
    return out


def _roots(count: int, links: list[tuple[int, np.ndarray]], names: np.ndarray) -> np.ndarray:
    """The least name among those that each member reaches."""
    parent = list(range(count))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, near in links:
        for j in near.tolist():
            a, b = find(i), find(j)
            if a != b:
                keep, drop = (a, b) if names[a] <= names[b] else (b, a)
                parent[drop] = keep
    return names[[find(i) for i in range(count)]]


def near_embeddings(
    vectors: DataFrame, threshold: float = 0.93, recall: float = 0.995, deviations: float = 4.0,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per row: vec_id, n_links, component_id and kept (the least id of its component).

    Only vectors of equal, non-null labels and equal lengths are compared. A vector that is null or zero, or holds null
    or non-finite components, links with nothing, and so does a row with a null id: it has no component, and is kept.
    Equal vectors are one class with a weight and are not compared with each other. Rows that repeat an id with another
    vector share their counts. An empty table gives no rows. recall is the least chance that a pair at the threshold
    meets; deviations is the width of the confidence bound.
    """
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists(v, lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    classes = rows.where("usable").groupBy("label", "v").agg(F.min("vec_id").alias("cls"), F.count("*").alias("weight"))
    classes = stored(classes, "vector-classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = tables_for(largest, threshold, recall)
    kind = classes.schema["label"].dataType.simpleString()
    id_kind = classes.schema["cls"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("v")
            sizes = np.diff(values.offsets.to_numpy())
            packed, factor, keys = [None] * len(sizes), np.ones(len(sizes)), np.zeros((len(sizes), tables), np.int32)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                x = np.array([values[i].as_py() for i in at.tolist()])
                x /= np.abs(x).max(1, keepdims=True)
                x /= np.sqrt((x * x).sum(1, keepdims=True))
                signs, factor[at] = encode(x)
                keys[at] = bucket_keys(x, bits, tables)
                for i, s in zip(at.tolist(), signs, strict=True):
                    packed[i] = s.tobytes()
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * tables), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packed, pa.binary()), pa.array(factor), flat], [*batch.schema.names, "code", "factor", "keys"])

    coded = stored(classes.mapInArrow(code, f"label {kind}, v array<double>, cls {id_kind}, weight bigint, code binary, factor double, keys array<int>"), "vector-codes")
    bucket = ["label", "size", "table", "key"]
    placed = coded.select("label", F.size("v").alias("size"), F.posexplode("keys").alias("table", "key"), "cls", "weight", "v", "code", "factor", "keys")
    crowds = placed.groupBy(*bucket).agg(F.count("*").alias("crowd"))
    blocks = F.ceil(F.col("crowd") / BLOCK).cast("int")
    tiles = (
        placed.join(crowds.where("crowd > 1"), bucket).withColumn("blocks", blocks)
        .withColumn("side", F.pmod(F.xxhash64("cls", "v"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*bucket, F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "cls", "weight", "v", "code", "factor", "keys")
    )
    group = [*bucket, "low", "high"]
    tiles = tiles.repartition(*group).sortWithinPartitions(*group, "cls")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tile(part: pa.Table) -> pa.RecordBatch | None:
            x = np.array(part.column("v").to_pylist())
            codes = np.array([np.frombuffer(c, np.uint8) for c in part.column("code").to_pylist()])
            names, weight = part.column("cls").to_numpy(), part.column("weight").to_numpy()
            found = links_in_tile(x, codes, part.column("factor").to_numpy(), part.column("side").to_numpy(), np.array(part.column("keys").to_pylist()), part.column("table")[0].as_py(), threshold, deviations)
            if not found:
                return None
            total = np.zeros(len(x), np.int64)
            for i, near in found:
                total[i] += weight[near].sum()
                total[near] += weight[i]
            roots = _roots(len(x), found, names)
            at = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays([pa.array(names[at]), pa.array(total[at]), pa.array(roots[at])], ["cls", "n", "root"])

        for part in groups(batches, group):
            if part.num_rows > 1 and (out := tile(part)) is not None:
                yield out

    found = stored(tiles.mapInArrow(compare, f"cls {id_kind}, n bigint, root {id_kind}"), "vector-links")
    counts = found.groupBy("cls").agg(F.sum("n").alias("n"))
    reached = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")), "vector-edges")
    facts = counts.join(reached.withColumnRenamed("node", "cls"), "cls", "left")
    known = classes.join(facts, "cls", "left").select(
        F.col("label").alias("l"), F.col("v").alias("w"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "cls").alias("component_id"))
    out = rows.join(known, F.col("usable") & (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")), "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"))
