"""Token-id files: every id in the fewest bits that the vocabulary needs, in blocks that are read at random.

A file set is a Parquet folder of blocks in document order. A block holds whole documents: their ids, the place of each
in the block, and one payload of packed bits. Any block is found by its first document's place and unpacked alone, with
numpy; a document longer than a block gets a block of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concordat.llm.chunks import library_encoder
from concordat.llm.shared import scratch, vocabulary

#: Ids in a block, unless one document has more.
BLOCK_IDS = 1 << 16

_BLOCK = "shard int, block int, bits int, n_tokens bigint, doc_ids array<{kind}>, offsets array<bigint>, payload binary"


def bits_for(vocabulary_size: int) -> int:
    """Bits that hold every id below vocabulary_size."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive fields of the given width, lowest bit first, filled up with zeros to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    fields = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(fields.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int = 0, count: int | None = None) -> np.ndarray:
    """The count ids from place start on, reading only their bytes."""
    if bits in (8, 16, 32):
        whole = np.frombuffer(payload, f"<u{bits // 8}")
        return whole[start : None if count is None else start + count].astype(np.uint32)
    total = len(payload) * 8 // bits if count is None else start + count
    first = start * bits
    raw = np.frombuffer(payload, np.uint8)[first // 8 : -(-total * bits // 8)]
    loose = np.unpackbits(raw, bitorder="little")[first % 8 :][: (total - start) * bits].reshape(-1, bits)
    return (loose.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


def write_token_files(
    docs: DataFrame, vocabulary_path: str, path: str, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode whole texts and write their blocks under path, in ascending order of the document id.

    A null text counts as empty, a null id sorts first, rows of equal ids stay side by side. Texts are dealt out by id
    range once, and each task packs the documents of its range as they come, so memory holds one block.
    """
    import json

    spark = docs.sparkSession
    vocab = vocabulary(spark, vocabulary_path)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = _BLOCK.format(kind=kind)
    id_type = pa.int64() if kind == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocab.value)
        spec = json.loads(vocab.value)
        largest = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]), end_id or 0])
        bits, shard, number = bits_for(largest + 1), TaskContext.get().partitionId(), 0
        held_ids, held, size = [], [], 0

        def block() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in held])]).tolist()
            payload = pack(np.concatenate(held), bits)
            values = [[shard], [number], [bits], [offsets[-1]], [held_ids], [offsets], [payload]]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(id_type or batch.schema.field(0).type), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], [c.split()[0] for c in schema.split(", ")])

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1)), strict=True):
                if end_id is not None:
                    ids = np.append(ids, np.uint32(end_id))
                if held and size + len(ids) > BLOCK_IDS:
                    yield block()
                    held_ids, held, size, number = [], [], 0, number + 1
                held_ids.append(key)
                held.append(ids)
                size += len(ids)
        if held:
            yield block()

    ordered = docs.select(id_col, text_col).repartitionByRange(F.col(id_col).asc_nulls_first()).sortWithinPartitions(F.col(id_col).asc_nulls_first())
    ordered.mapInArrow(run, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it), n_tokens, ids_crc32, and the ids if asked for.

    Starts follow from the token counts of the blocks, a small table; payloads are only read to unpack them.
    """
    blocks = spark.read.parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", "n_tokens").join(shards, "shard").select(
        "shard", "block", (F.col("shard_start") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("block_start"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    arrow_ids = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, offsets, payload, bits, start = (batch.column(i)[row] for i in range(5))
                places = np.array(offsets.as_py(), np.int64)
                loose = unpack(payload.as_py(), bits.as_py(), 0, int(places[-1]))
                parts = [loose[a:b] for a, b in zip(places, places[1:], strict=False)]
                columns = [
                    doc_ids.values, pa.array(places[:-1] + start.as_py(), pa.int64()), pa.array(np.diff(places), pa.int64()),
                    pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if ids:
                    columns, names = [*columns, pa.array([p.tolist() for p in parts], arrow_ids)], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    found = blocks.join(starts, ["shard", "block"]).select("doc_ids", "offsets", "payload", "bits", "block_start")
    return found.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if ids else ""))


def token_files(docs: DataFrame, vocabulary_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Write the files and read them back. An empty table gives empty files and no rows."""
    spark = docs.sparkSession
    path = path or scratch(spark, "token-files")
    write_token_files(docs, vocabulary_path, path, end_id, id_col, text_col)
    return read_token_files(spark, path)
