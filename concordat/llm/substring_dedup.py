"""Removal of passages that an earlier document holds, by parsing documents relative to indexed reference blocks.

Documents are put in order of their ids and cut into blocks; every block is both parsed and a reference for what comes
after it. A block's index is the sorted fingerprints of its phrases of WIDTH words. All indexes are dealt out by
fingerprint, so one exchange tells each block which of its phrases start in any earlier block; which start in an earlier
document of the block itself is found in place. A document is then parsed greedily: a factor begins at a phrase that a
reference holds and goes on while the next phrase is held too, and phrases across the ends of factors are looked up like
all others. Factors of WIDTH words or more are the duplicate spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.phrases import WordHashes, runs
from concordat.llm.shared import stored

WIDTH = 13
#: A block ends with the document that brings it to so many bytes.
BLOCK_BYTES = 16 << 20
#: Fingerprints that meet in one task, about; there are at least so many buckets.
BUCKET_PHRASES, LEAST_BUCKETS = 1 << 20, 512
#: What a block gives is handed over in parts of so many pieces of its index, or of so many bytes of text, one document at least.
PART_PIECES, PART_BYTES = 128, 1 << 20


def squeeze(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, by byte position, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unsqueeze(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def distinct(held: list[np.ndarray]) -> np.ndarray:
    """The different keys, sorted. held is emptied: its arrays go before the keys are sorted in place."""
    keys = np.concatenate(held)
    held.clear()
    keys.sort()
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return keys[new]


def held_before(flat: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of each key whether it is also there with a smaller rank; ranks do not fall. Only keys that repeat are looked at."""
    by_key = np.argsort(flat, kind="stable")  # the first of a key has its least rank
    ordered = flat[by_key]
    again = np.zeros(len(flat) + 1, bool)
    np.equal(ordered[1:], ordered[:-1], out=again[1:-1])
    del ordered
    many = again[1:] | again[:-1]
    by_key, new = by_key[many], ~again[:-1][many]
    ranks = rank[by_key]
    held = np.zeros(len(flat), bool)
    held[by_key] = ranks[new][np.cumsum(new) - 1] < ranks
    return held


def factors(held: np.ndarray, width: int = WIDTH) -> list[tuple[int, int]]:
    """(first word, end) of the factors of a document, of which held tells the phrases that a reference holds."""
    steps = np.diff(np.concatenate([[0], held.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1) + width - 1
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def _kept(count: int, spans: list[tuple[int, int]]) -> np.ndarray:
    keep = np.ones(count, bool)
    for a, b in spans:
        keep[a:b] = False
    return keep


def _squeezed(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([small.compress(x.as_py()) for x in batch.column(1)], pa.binary()), batch.column(2)], ["doc_id", "body", "rest"])

    return docs.mapInArrow(run, f"doc_id {kind}, body binary, rest {docs.schema['rest'].dataType.simpleString()}")


def _blocks(docs: DataFrame, name: str) -> DataFrame:
    """doc_id, compressed text and block, in order of the ids; documents of equal ids share a block."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, last = TaskContext.get().partitionId() << 24, 0, None
        for batch in batches:
            marks = []
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if size >= BLOCK_BYTES and key != last:
                    block, size = block + 1, 0
                size += zstandard.frame_content_size(body.as_buffer())
                last = key
                marks.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int64())], [*batch.schema.names, "block"])

    ordered = _squeezed(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return stored(ordered.mapInArrow(run, f"doc_id {kind}, body binary, rest {docs.schema['rest'].dataType.simpleString()}, block bigint"), name)


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, spans (start and end word of the factors removed).

    Words are runs of other than ASCII white space. A word goes if it lies in a run of width words that also starts in a
    document with a smaller id, in the input as given; kept words are joined by one space. carry names columns to return as the struct rest, beside
    kept: the text as it was if nothing is removed, else the kept words.
    A null text has no words; documents with a null id are no reference, and keep all; of rows that repeat an id none is
    smaller than the other; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"),
                        F.struct(*[F.col(c) for c in carry]).alias("rest") if carry else F.lit(True).alias("rest"))
    rest_kind = plain.schema["rest"].dataType.simpleString()
    blocks = _blocks(plain.where("doc_id IS NOT NULL"), "reference-blocks")
    bytes_in = plain.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, bytes_in // 6 // BUCKET_PHRASES)
    bits = (int(buckets) - 1).bit_length()

    def phrases(text: bytes, hashes: WordHashes) -> np.ndarray:
        return runs(hashes.of(text.split()), width)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sorted fingerprints of each block, cut by bucket."""
        hashes, unpack = WordHashes(), zstandard.ZstdDecompressor()
        block, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            keys = distinct(held)
            cuts = [*np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist(), len(keys)]
            full = [b for b in range(1 << bits) if cuts[b] < cuts[b + 1]]
            for at in range(0, len(full), PART_PIECES):
                some = full[at : at + PART_PIECES]
                pieces = pa.array([squeeze(keys[cuts[b] : cuts[b + 1]]) for b in some], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([block] * len(some), pa.int64()), pieces], ["bucket", "block", "keys"])

        for batch in batches:
            for body, own in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if block is not None and own != block:
                    yield from flush()
                block = own
                held.append(phrases(unpack.decompress(body.as_py()), hashes))
        if held:
            yield from flush()

    def compare(part: pa.Table) -> pa.Table:
        """For each block, its keys of this bucket that an earlier block holds."""
        order = np.argsort(part.column("block").to_numpy(), kind="stable")
        packed, own = part.column("keys").to_pylist(), part.column("block").to_numpy()
        keys = [unsqueeze(packed[i]) for i in order.tolist()]
        which = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        flat = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        by_key = np.argsort(flat, kind="stable")
        later = np.concatenate([[False], flat[by_key][1:] == flat[by_key][:-1]]) if len(flat) else np.empty(0, bool)
        found, where = flat[by_key[later]], which[by_key[later]]
        rows = [(int(own[order[i]]), squeeze(found[where == i])) for i in np.unique(where).tolist()]
        columns = list(zip(*rows, strict=True)) or [[], []]
        return pa.table({"block": pa.array(columns[0], pa.int64()), "keys": pa.array(columns[1], pa.binary())})

    def parse(texts: pa.Table, known: pa.Table) -> pa.Table:
        hashes, unpack = WordHashes(), zstandard.ZstdDecompressor()
        earlier = np.concatenate([np.empty(0, np.uint64), *map(unsqueeze, known.column("keys").to_pylist())])
        earlier.sort()
        ids, bodies = texts.column("doc_id").to_pylist(), texts.column("body").to_pylist()
        id_type, rest = texts.schema.field("doc_id").type, texts.column("rest") if carry else None
        order = sorted(range(len(ids)), key=ids.__getitem__)
        own = [phrases(unpack.decompress(bodies[i]), hashes) for i in order]
        ends = np.cumsum([0, *map(len, own)]).tolist()
        flat = np.concatenate([np.empty(0, np.uint64), *own])
        del own
        ranks = np.cumsum([place > 0 and ids[i] != ids[order[place - 1]] for place, i in enumerate(order)], dtype=np.int32)
        held = held_before(flat, np.repeat(ranks, np.diff(ends)))

        def part(first: int, rows: list[tuple]) -> pa.Table:
            return _table(rows, id_type, rest.take(pa.array(order[first : first + len(rows)], pa.int64())) if carry else None)

        parts, rows, size = [], [], 0
        for place, i in enumerate(order):
            mine, keys = held[ends[place] : ends[place + 1]], flat[ends[place] : ends[place + 1]]
            if len(earlier):
                mine |= earlier[np.minimum(np.searchsorted(earlier, keys), len(earlier) - 1)] == keys
            text = unpack.decompress(bodies[i])
            rows.append(_row(ids[i], text, factors(mine, width), bool(carry)))
            size += len(text)
            if size >= PART_BYTES:
                parts.append(part(place + 1 - len(rows), rows))
                rows, size = [], 0
        return pa.concat_tables([*parts, part(len(order) - len(rows), rows)])

    index_rows = blocks.select("body", "block").mapInArrow(index, "bucket bigint, block bigint, keys binary")
    earlier = index_rows.groupBy("bucket").applyInArrow(compare, "block bigint, keys binary")
    schema = f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, spans array<struct<start:int,stop:int>>" + (f", kept string, rest {rest_kind}" if carry else "")
    parsed = blocks.groupBy("block").cogroup(earlier.groupBy("block")).applyInArrow(parse, schema)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(None, x.as_py(), [], bool(carry)) for x in batch.column(1)]
            yield from _table(rows, batch.schema.field(0).type, batch.column(2) if carry else None).to_batches()

    return parsed.union(plain.where("doc_id IS NULL").mapInArrow(whole, schema))


def _row(key, text: bytes, spans: list[tuple[int, int]], with_text: bool) -> tuple:
    words = text.split()
    if spans:
        keep = _kept(len(words), spans)
        left = [words[i] for i in np.flatnonzero(keep).tolist()]
    else:
        left = words
    joined = b" ".join(left)
    row = (key, len(words), len(words) - len(left), hashlib.sha256(joined).hexdigest(), [{"start": a, "stop": b} for a, b in spans])
    return (*row, (joined if spans else text).decode()) if with_text else row


def _table(rows: list[tuple], id_type: pa.DataType, rest) -> pa.Table:
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"] + ["kept"] * (rest is not None)
    kinds = [id_type, pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.string()]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    found = {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=False)}
    return pa.table(found if rest is None else found | {"rest": rest})


def drop_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the words that duplicate_spans removes, with all their columns, carried by place.

    A column n_chars, if there is one, is set to the length of what is left of a text that lost words.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    found = duplicate_spans(plain, key, text, width, [c for c in plain.columns if c != text])
    kept = F.when(F.col("n_words") > 0, F.col("kept"))
    columns = []
    for i, name in enumerate(names):
        column = F.col(f"rest.c{i}") if f"c{i}" != text else kept
        if name == "n_chars":
            column = F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema.fields[i].dataType)).otherwise(column)
        columns.append(column.alias(f"c{i}"))
    return found.select(*columns).toDF(*names)
