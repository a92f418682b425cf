"""Hard-negative mining with score windows that are shared out to slots.

Every positive of an anchor opens a window of scores for its negatives, and the windows overlap. Their upper limits cut the
scores below the highest into disjoint slots. Each block of rows keeps the best k negatives of each slot; the combined k
best of a slot, and of all slots below it, come from one merge from the lowest slot upward. A window is then the list of
the slot that its upper limit closes, as far as its lower limit, so no window is searched by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.shared import stored
from concordat.llm.vectors import Block, first_of, in_tiles, longs, whole_vectors

#: Scores computed at a time.
SCORES = 1 << 22


def window(score: int, lower: int, upper: int) -> tuple[int, int]:
    """The least and the greatest whole score s with lower * score <= 100 * s <= upper * score."""
    return -(-lower * score // 100), upper * score // 100


def slot_limits(scores: list[int], lower: int, upper: int) -> tuple[list[int], int]:
    """(upper limits of the windows that hold a score, falling and distinct; the least score in any of them)."""
    open_ = [w for w in (window(s, lower, upper) for s in scores) if w[0] <= w[1]]
    return sorted({w[1] for w in open_}, reverse=True), min((w[0] for w in open_), default=0)


def merge_slots(slots: list[list[tuple[int, int]]], k: int) -> list[list[tuple[int, int]]]:
    """For each slot the k best of it and all below; every slot is sorted and lies wholly above the next."""
    out: list[list[tuple[int, int]]] = []
    below: list[tuple[int, int]] = []
    for own in reversed(slots):
        below = (own + below)[:k]
        out.append(below)
    return out[::-1]


def _batch(parts: list[tuple], names: list[str]) -> pa.RecordBatch | None:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names) if parts else None


def _best_positives(k: int):
    def start(block: Block):
        places = {name: np.flatnonzero(block.labels == name) for name in set(block.labels.tolist())}

        def ask(batch: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch | None:
            own, labels, keys = batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False), batch.column(6).to_numpy()
            out = []
            for name in set(labels.tolist()) & places.keys():
                at, asks = places[name], np.flatnonzero(labels == name)
                ids, rows = block.ids[at], block.x[at]
                step = max(1, SCORES // len(at))
                for some in (asks[i : i + step] for i in range(0, len(asks), step)):
                    for i, scores in zip(some.tolist(), longs(x[some] @ rows.T), strict=True):
                        other = np.flatnonzero(ids != own[i])
                        best = other[first_of(scores[other], ids[other], k)]
                        out.append((np.full(len(best), keys[i]), ids[best], scores[best]))
            return _batch(out, ["key", "positive_id", "positive_score"])

        return ask

    return start


def _best_in_slots(k: int, lower: int, upper: int):
    def start(block: Block):
        def ask(batch: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch | None:
            labels, keys, positives = batch.column(3).to_numpy(zero_copy_only=False), batch.column(6).to_numpy(), batch.column(7).to_pylist()
            step, out = max(1, SCORES // len(block.ids)), []
            for at in range(0, len(x), step):
                for i, scores in enumerate(longs(x[at : at + step] @ block.x.T), at):
                    limits, floor = slot_limits(positives[i], lower, upper)
                    if not limits:
                        continue
                    near = np.flatnonzero((scores >= floor) & (scores <= limits[0]) & (block.labels != labels[i]))
                    slot = np.searchsorted(-np.array(limits), -scores[near], "right") - 1
                    for number in np.unique(slot).tolist():
                        own = near[slot == number]
                        own = own[first_of(scores[own], block.ids[own], k)]
                        out.append((np.full(len(own), keys[i]), np.full(len(own), number, np.int32), block.ids[own], scores[own]))
            return _batch(out, ["key", "slot", "negative_id", "negative_score"])

        return ask

    return start


def hard_negatives(
    vectors: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 5, lower: int = 80, upper: int = 100, scale: float = 256.0,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the first negatives of every positive.

    anchors says which rows ask, label what rows are called. An anchor's positives are the first rows of its label; those
    of other labels with lower * positive_score <= 100 * negative_score <= upper * positive_score are its negatives, and
    the first of them are returned, ranked from 1. Rows come by score, the inner product of vectors with each component x
    replaced by floor(scale * x), highest first, ties by smaller id. Fewer where there are fewer; none where a score is
    negative, as its window is empty. upper is at most 100.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part. Equal rows each answer,
    but ask once; rows that share an id and differ ask each, and are never their own positives. A shorter vector counts as
    0 in what it lacks. Scores beyond 64 bits are held at their ends. An empty table, and one without anchors, gives no rows.
    """
    rows, shape = whole_vectors(vectors.where(label.isNotNull()), scale, id_col, vector_col, label)
    asked = whole_vectors(vectors.where(label.isNotNull() & anchors), scale, id_col, vector_col, label)[0].distinct()
    asked = stored(asked.withColumn("key", F.monotonically_increasing_id()), "anchors")
    found = in_tiles(rows, asked, shape, _best_positives(positives), "key bigint, positive_id bigint, positive_score bigint")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id"))
    best = stored(found.withColumn("place", place).where(F.col("place") <= positives), "positives")
    listed = best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    asking = stored(asked.join(listed, "key").select("id", "label", "dims", "q", "key", F.col("positives.positive_score").alias("scores")), "asking")
    in_slot = in_tiles(rows, asking, shape, _best_in_slots(negatives, lower, upper), "key bigint, slot int, negative_id bigint, negative_score bigint")
    place = F.row_number().over(Window.partitionBy("key", "slot").orderBy(F.desc("negative_score"), "negative_id"))
    in_slot = in_slot.withColumn("place", place).where(F.col("place") <= negatives)
    slots = in_slot.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("slot", "place", "negative_id", "negative_score"))).alias("slots"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for anchor, own, kept in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                limits, _ = slot_limits([p["positive_score"] for p in own], lower, upper)
                each: list[list[tuple[int, int]]] = [[] for _ in limits]
                for c in kept:
                    each[c["slot"]].append((c["negative_id"], c["negative_score"]))
                merged = merge_slots(each, negatives)
                for p in own:
                    least, most = window(p["positive_score"], lower, upper)
                    if least <= most:
                        chosen = [c for c in merged[limits.index(most)] if c[1] >= least]
                        out += [(anchor, p["positive_id"], rank, i, p["positive_score"], s) for rank, (i, s) in enumerate(chosen, 1)]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    both = asked.select("key", F.col("id").alias("anchor_id")).join(listed, "key").join(slots, "key").select("anchor_id", "positives", "slots")
    return both.mapInArrow(merge, "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
