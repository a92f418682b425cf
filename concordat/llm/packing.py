"""Packing documents into training windows by Karmarkar-Karp multiway differencing.

Each task packs the documents it scans, a bounded group at a time. Tokens that fill whole windows are cut off first. The
rests of a group become partial partitions; the two with the largest imbalance are merged again and again, the heavy
windows of one with the light windows of the other, until one near-equal partition is left. The window count rises while
a window exceeds the capacity. What is then still free is filled from the last windows, and a last part that fills no
window is cut into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from concordat.llm.chunks import library_encoder
from concordat.llm.shared import vocabulary

#: Rests in a group. Its state is at most this many times the window, whatever the size of the input.
GROUP_PIECES = 512

Piece = tuple[int, int, int]  # place of the document in the group, start in it, length


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Split the indices of sizes into at most so many windows with near-equal sums. Ties keep the order of sizes."""
    heap: list[tuple[int, int, list[tuple[int, list[int]]]]] = []
    for at, size in enumerate(sizes):
        heap.append((-size if windows > 1 else 0, at, [(size, [at])]))
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # Both are sorted, heaviest first; empty windows are left out. Only windows that both fill are added up.
        shared = max(0, len(a) + len(b) - windows)
        free_a, free_b = a[: len(a) - shared], b[: len(b) - shared]
        tail_b = b[len(b) - shared :][::-1]
        merged = free_a + free_b + [(x + y, p + q) for (x, p), (y, q) in zip(a[len(a) - shared :], tail_b, strict=True)]
        merged.sort(key=lambda w: -w[0])
        least = merged[-1][0] if len(merged) == windows else 0
        heapq.heappush(heap, (least - merged[0][0], count, merged))
        count += 1
    return [members for _, members in heap[0][2]] if heap else []


def pack_group(sizes: list[int], capacity: int) -> list[list[Piece]]:
    """Sequences for documents of the given sizes; every token lies in exactly one piece.

    Sequences are full, or their length is a power of two.
    """
    out: list[list[Piece]] = []
    rests: list[Piece] = []
    for at, size in enumerate(sizes):
        whole = size - size % capacity
        out += [[(at, start, capacity)] for start in range(0, whole, capacity)]
        if size > whole:
            rests.append((at, whole, size - whole))
    lengths = [r[2] for r in rests]
    total = sum(lengths)
    windows = -(-total // capacity)
    split = differencing(lengths, windows)
    while any(sum(lengths[i] for i in w) > capacity for w in split):
        windows += 1
        split = differencing(lengths, windows)
    packed = [[rests[i] for i in w] for w in split]
    # Fill what is free in the fuller windows with tokens cut from the emptiest ones.
    packed.sort(key=lambda w: -sum(p[2] for p in w))
    spare: list[Piece] = []
    free = 0
    while packed:
        window = packed[free] if free < len(packed) else None
        if window is None:
            break
        need = capacity - sum(p[2] for p in window)
        while need and (spare or len(packed) > free + 1):
            if not spare:
                spare = packed.pop()
            at, start, length = spare.pop()
            taken = min(length, need)
            window.append((at, start, taken))
            need -= taken
            if length > taken:
                spare.append((at, start + taken, length - taken))
        if need:
            spare = packed.pop(free) + spare
            break
        free += 1
    out += packed
    left = sum(p[2] for p in spare)
    while left:
        # The largest power of two that is left.
        need = 1 << (left.bit_length() - 1)
        left -= need
        window = []
        while need:
            at, start, length = spare.pop()
            taken = min(length, need)
            window.append((at, start, taken))
            need -= taken
            if length > taken:
                spare.append((at, start + taken, length - taken))
        out.append(window)
    return out


def id_lists(parts: list[np.ndarray]) -> pa.ListArray:
    """The ids of each piece as a list, without a Python object for each id."""
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(parts).view(np.int32))


def pack_documents(
    docs: DataFrame, vocabulary_path: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with_ids adds the ids.

    A null text counts as empty and still yields its end id; a null id stays null; repeated rows are packed each; an
    empty table gives no rows. Nothing is shuffled. A sequence id is the task's number times 2**32 plus a counter.
    """
    vocab = vocabulary(docs.sparkSession, vocabulary_path)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocab.value)
        sequence = TaskContext.get().partitionId() << 32
        keys: list = []
        texts: list[np.ndarray] = []
        held = 0

        def group(id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal sequence
            rows: list[tuple] = []
            ids = []
            for window in pack_group([len(t) for t in texts], capacity):
                offset = 0
                for at, start, length in window:
                    part = texts[at][start : start + length]
                    rows.append((keys[at], start, length, zlib.crc32(part.astype("<u4").tobytes()), len(texts[at]), sequence, offset))
                    ids.append(part)
                    offset += length
                sequence += 1
            columns = [pa.array(c, id_type if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))]
            if with_ids:
                columns.append(id_lists(ids))
            return pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1)), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                keys.append(key)
                texts.append(ids)
                held += len(ids)
                if len(keys) >= GROUP_PIECES or held >= GROUP_PIECES * capacity:
                    yield group(id_type)
                    keys, texts, held = [], [], 0
            del batch  # before the next one is read
        if keys:
            yield group(id_type)

    schema = f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names[1:])
    return docs.select(id_col, text_col).mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
