"""Language-model scores by prediction by partial matching over bytes.

The model is the trie of all byte contexts of up to ORDER bytes in the training texts with the counts of what follows.
A byte is coded in its longest known context; what a context has not seen escapes to the next shorter one, with as many
escape counts as the context has distinct followers, and there the followers of the longer context are excluded.

Counts are gathered per chunk of documents, packed in arrays and dealt out by the last three context bytes, so all
contexts of three or more bytes of an n-gram meet in one place; shorter ones need the table of trigrams alone, which
has at most 2**24 rows. Each chunk gets back the values of its own n-grams and words and scores its documents with them,
so nothing that grows with the corpus is held or broadcast whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.shared import groups, held_out, stored
from concordat.llm.substring_dedup import squeeze, unsqueeze

ORDER = 5
LOW = 3
#: Never in UTF-8 text: stands before a text as context and after it as its end.
EDGE = 0xFF
#: A chunk ends with the document that brings it to so many bytes.
CHUNK_BYTES = 16 << 20
BUCKETS = 512
#: Chunks whose arrays meet in one task.
BLOCK_CHUNKS = 1024
GRAMS, WORDS = 0, 1
_PIECE = 4 << 20

Table = tuple[np.ndarray, np.ndarray]  # sorted keys, counts


def _zip(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unzip(packed: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)


def mask(size: int) -> np.uint64:
    return np.uint64((1 << 8 * size) - 1)


def gram_codes(text: bytes) -> np.ndarray:
    """For every byte of the text and its end: the ORDER bytes before it, and itself, as one number."""
    raw = np.frombuffer(bytes([EDGE]) * ORDER + text + bytes([EDGE]), np.uint8)
    size = len(text) + 1
    code = np.zeros(size, np.uint64)
    for i in range(ORDER + 1):
        code = (code << np.uint64(8)) | raw[i : i + size]
    return code


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> Table:
    """The distinct keys, sorted, with their summed counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def look_up(table: Table, keys: np.ndarray) -> np.ndarray:
    """Counts of keys, 0 for those not there."""
    if not len(table[0]):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return np.where(table[0][at] == keys, table[1][at], 0)


class Trie:
    """Counts of every order up to the given one, from the table of its longest n-grams."""

    def __init__(self, longest: Table, order: int, shortest: int, below: Table | None):
        self.order, self.shortest = order, shortest
        keep = longest[1] > 0
        self.grams = {order: (longest[0][keep], longest[1][keep])}
        for k in range(order - 1, shortest - 1, -1):
            keys, counts = self.grams[k + 1]
            self.grams[k] = merged([keys & mask(k + 1)], [counts])
        self.total, self.kinds, self.passed_on = {}, {}, {}
        for k in range(order, shortest - 1, -1):
            keys, counts = self.grams[k]
            contexts = keys >> np.uint64(8)
            lower = self.grams[k - 1] if k > shortest else below
            shorter = look_up(lower, keys & mask(k)) if k and lower is not None else np.zeros(len(keys), np.int64)
            self.total[k] = merged([contexts], [counts])
            self.kinds[k] = merged([contexts], [np.ones(len(keys), np.int64)])
            self.passed_on[k] = merged([contexts], [shorter])

    def walk(self, grams: np.ndarray, state: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> tuple:
        """Go down the orders. state: log10 so far, whether it is coded, and count and kinds of the excluded followers."""
        value, coded, left_out, kinds_out = state
        for k in range(self.order, self.shortest - 1, -1):
            context, gram = (grams >> np.uint64(8)) & mask(k), grams & mask(k + 1)
            n, kinds = look_up(self.grams[k], gram), look_up(self.kinds[k], context)
            fresh = kinds - kinds_out
            whole = look_up(self.total[k], context) - left_out + fresh
            open_ = ~coded & (kinds > 0) & (fresh > 0)
            hit = open_ & (n > 0)
            value = value + np.where(open_, np.log10(np.where(hit, n, np.maximum(fresh, 1)) / np.maximum(whole, 1)), 0)
            coded = coded | hit
            left_out, kinds_out = look_up(self.passed_on[k], context), kinds
        return value, coded, left_out, kinds_out


def start_state(count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return np.zeros(count), np.zeros(count, bool), np.zeros(count, np.int64), np.zeros(count, np.int64)


def _bucket(kind: int, keys: np.ndarray) -> np.ndarray:
    part = (keys >> np.uint64(8)) & mask(LOW) if kind == GRAMS else keys
    return ((part * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % BUCKETS


def _chunked(docs: DataFrame, id_col: str, text_col: str, modulus: int, remainder: int) -> DataFrame:
    """doc_id, compressed lower-case bytes, held_out and the chunk, dealt out as the rows are scanned."""
    kind = docs.schema[id_col].dataType.simpleString()
    work = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"), held_out(id_col, modulus, remainder).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            marks = []
            small = zstandard.ZstdCompressor(level=1)
            bodies = pa.array([small.compress(x.as_py().lower()) for x in batch.column(1)], pa.binary())
            for n in pc.binary_length(batch.column(1)).to_pylist():
                marks.append(chunk)
                size += n
                if size >= CHUNK_BYTES:
                    chunk, size = chunk + 1, 0
            yield pa.RecordBatch.from_arrays([batch.column(0), bodies, batch.column(2), pa.array(marks, pa.int64())], [*batch.schema.names, "chunk"])

    return stored(work.mapInArrow(run, f"doc_id {kind}, bytes binary, held_out boolean, chunk bigint"), "lm-chunks")


def _packed(kind: int, chunk: int, table: Table) -> list[tuple]:
    """Rows of one table, cut by bucket."""
    bucket = _bucket(kind, table[0])
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
    keys, counts = table[0][order], table[1][order]
    return [(kind, b, chunk, squeeze(keys[x:y]), _zip(counts[x:y].astype("<i8"))) for b, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if y > x]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams and words of each chunk, with how often training texts hold them."""
    names = ["kind", "bucket", "chunk", "keys", "counts"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    chunk, pending, size = None, [], 0
    tables: list[Table] = []
    seen: Counter = Counter()
    unpack = zstandard.ZstdDecompressor()

    def gather() -> None:
        nonlocal pending, size
        if pending:
            for training in (True, False):
                texts = [t for t, out in pending if out is not training]
                if texts:
                    keys, counts = np.unique(np.concatenate([gram_codes(t) for t in texts]), return_counts=True)
                    tables.append((keys, counts if training else np.zeros(len(keys), np.int64)))
            tables[:] = [merged([t[0] for t in tables], [t[1] for t in tables])]
        pending, size = [], 0

    def flush() -> pa.RecordBatch:
        gather()
        words = np.fromiter(map(xxhash.xxh64_intdigest, seen), np.uint64, len(seen))
        order = np.argsort(words)
        found = (words[order], np.fromiter(seen.values(), np.int64, len(seen))[order])
        rows = [*(_packed(GRAMS, chunk, tables[0]) if tables else []), *_packed(WORDS, chunk, found)]
        tables.clear()
        seen.clear()
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        for text, out, own in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if chunk is not None and own != chunk:
                yield flush()
            chunk = own
            text = unpack.decompress(text.as_py())
            words = text.split()
            if out:
                for w in words:
                    seen.setdefault(w, 0)
            else:
                seen.update(words)
            pending.append((text, out))
            size += len(text)
            if size >= _PIECE:
                gather()
    if chunk is not None:
        yield flush()


def _arrays(part: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    return [unsqueeze(x) for x in part.column("keys").to_pylist()], [_unzip(x, "<i8") for x in part.column("counts").to_pylist()]


def _sum(keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(batches, keys):
            found = merged(*_arrays(part))
            seen = found[1] > 0
            row = {c: [part.column(c)[0].as_py()] for c in keys} | {"keys": [squeeze(found[0][seen])], "counts": [_zip(found[1][seen])], "n": [int(found[1].sum())], "v": [int(seen.sum())]}
            if row["kind"][0] == GRAMS:
                low = merged([found[0][seen] & mask(LOW)], [found[1][seen]])
                row |= {"low": [low[0].astype(np.int64).tolist()], "low_counts": [low[1].tolist()]}
            else:
                row |= {"low": [[]], "low_counts": [[]]}
            kinds = {"keys": pa.binary(), "counts": pa.binary(), "low": pa.list_(pa.int64()), "low_counts": pa.list_(pa.int64()), "kind": pa.int32(), "bucket": pa.int32()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in row.items()], list(row))

    return run


_SUMS = "keys binary, counts binary, n bigint, v bigint, low array<bigint>, low_counts array<bigint>"


def language_model_scores(docs: DataFrame, modulus: int = 7, remainder: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (both log10).

    Texts whose crc32(id) mod modulus is the remainder are not learned from; a null id is. A null text counts as empty:
    its only token, and its only symbol, is the end. Repeated rows are learned from and scored each. An empty table gives
    no rows; with nothing to learn from, the score is uniform over 256 symbols. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    chunks = _chunked(docs, id_col, text_col, modulus, remainder)
    counted = stored(chunks.mapInArrow(_count, "kind int, bucket int, chunk bigint, keys binary, counts binary"), "lm-counts")
    blocks = max(1, -(-counted.select("chunk").distinct().count() // BLOCK_CHUNKS))
    dealt = counted.select("*", F.pmod(F.xxhash64("chunk"), F.lit(blocks)).alias("block"))
    first = ["kind", "bucket", "block"]
    partial = dealt.repartition(*first).sortWithinPartitions(*first).mapInArrow(_sum(first), f"kind int, bucket int, block bigint, {_SUMS}")
    second = ["kind", "bucket"]
    model = stored(partial.repartition(*second).sortWithinPartitions(*second).mapInArrow(_sum(second), f"kind int, bucket int, {_SUMS}"), "lm-model")

    totals = model.where(F.col("kind") == WORDS).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    trained = chunks.where(~F.col("held_out")).count()
    tokens, kinds = totals[0] + trained, totals[1] + (trained > 0)
    pairs = model.where(F.col("kind") == GRAMS).select(F.explode(F.arrays_zip("low", "low_counts")).alias("x")).groupBy("x.low").agg(F.sum("x.low_counts").alias("n")).orderBy("low").collect()
    trigrams = np.array([r[0] for r in pairs], np.uint64), np.array([r[1] for r in pairs], np.int64)
    low = spark.sparkContext.broadcast(trigrams)  # 2**24 rows at most

    def values(wanted: pa.Table, known: pa.Table) -> pa.Table:
        keys = [unsqueeze(x) for x in wanted.column("keys").to_pylist()]
        table = merged(*_arrays(known)) if known.num_rows else (np.empty(0, np.uint64), np.empty(0, np.int64))
        what = wanted.column("kind")[0].as_py() if wanted.num_rows else WORDS
        if what == GRAMS:
            deep, flat = Trie(table, ORDER, LOW, low.value), Trie(low.value, LOW - 1, 0, None)
            out = []
            for k in keys:
                value, coded, left_out, kinds_out = flat.walk(k, deep.walk(k, start_state(len(k))))
                out.append(_zip(np.where(coded, value, value - np.log10(np.maximum(256 - kinds_out, 1))).astype("<f4")))
        else:
            out = [_zip(look_up(table, k).astype("<i8")) for k in keys]
        return pa.table({"chunk": wanted.column("chunk").cast(pa.int64()), "kind": wanted.column("kind").cast(pa.int32()), "keys": wanted.column("keys"), "values": pa.array(out, pa.binary())})

    spread = model.select(*second, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"), "keys", "counts")
    priced = dealt.groupBy(*first).cogroup(spread.groupBy(*first)).applyInArrow(values, "chunk bigint, kind int, keys binary, values binary")

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        def table(what: int) -> tuple[np.ndarray, np.ndarray]:
            rows = [(k, v) for q, k, v in zip(known.column("kind").to_pylist(), known.column("keys").to_pylist(), known.column("values").to_pylist(), strict=True) if q == what]
            keys = np.concatenate([unsqueeze(k) for k, _ in rows] or [np.empty(0, np.uint64)])
            found = np.concatenate([_unzip(v, "<f4" if what == GRAMS else "<i8").astype(float) for _, v in rows] or [np.empty(0)])
            order = np.argsort(keys)
            return keys[order], found[order]

        (grams, logs), (words, counts) = table(GRAMS), table(WORDS)
        cached: dict[bytes, float] = {}
        unpack = zstandard.ZstdDecompressor()
        base_all = np.log10(tokens + kinds + 1)
        rows = []
        for text in texts.column("bytes"):
            text = unpack.decompress(text.as_py())
            own = text.split()
            for w in own:
                if w not in cached:
                    cached[w] = float(counts[np.searchsorted(words, np.uint64(xxhash.xxh64_intdigest(w)))])
            c = np.fromiter(map(cached.__getitem__, own), float, len(own))
            c = np.append(c, trained)
            total = 0.0
            for at in range(0, len(text) + 1, _PIECE):  # a piece with the context before it
                codes = gram_codes(text) if len(text) < _PIECE else _piece_codes(text, at)
                total += logs[np.searchsorted(grams, np.sort(codes))].sum()  # sorted keys are found faster
            rows.append((len(c), int((c > 0).sum()), tokens, float((np.log10(c + 1) - base_all).sum()), float(total)))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "n_tokens": pa.array(columns[0], pa.int64()), "n_known": pa.array(columns[1], pa.int64()),
            "train_tokens": pa.array(columns[2], pa.int64()), "base_score": pa.array(columns[3], pa.float64()), "score": pa.array(columns[4], pa.float64())})

    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return chunks.groupBy("chunk").cogroup(priced.groupBy("chunk")).applyInArrow(score, schema)


def _piece_codes(text: bytes, at: int) -> np.ndarray:
    """The codes of the symbols from place at on, up to the length of a piece."""
    codes = gram_codes(text[max(0, at - ORDER) : at + _PIECE])
    codes = codes[min(at, ORDER) : min(at, ORDER) + min(_PIECE, len(text) + 1 - at)]
    return codes
