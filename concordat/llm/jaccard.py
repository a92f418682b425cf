"""Jaccard self-join of word shingle sets, heavy and light sets treated apart.

Equal sets are one class. Light sets enumerate their subsets of every size that a link needs: sets that share one are
linked without looking at them again. Heavy sets are listed under the shingles of their prefix, rarest first, and lists
are scanned for pairs whose sizes and sketches allow a link; only those are compared in full. The boundary between light
and heavy is where the subsets begin to cost more than the lists, from the counts of the sizes. Rarity comes from a table
of hashed counts over all documents; it orders the shingles and cannot change the result.

Sketches count a set's shingles by hash; what the counts of two sets differ by bounds the sets' difference from below, so
no link is lost. Lists of near copies are not expanded: a long list only gives a spanning forest of what looks linked. Sets
that these forests connect are a family. Where the checked links leave a family in several parts, its sets meet in blocks
of bounded size, where they are compared in full at once, and a block gives no more links than join its parts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.phrases import WordHashes, runs
from concordat.llm.shared import components, groups, stored, working
from concordat.llm.substring_dedup import squeeze, unsqueeze

SLOTS = 1 << 21
SLICES = 16
SKETCH = 64
#: Lists up to this length give all their pairs; longer ones are cut into blocks that meet pairwise.
SHORT, BLOCK = 48, 1024
#: Shingles in a block of a family.
ELEMENTS = 1 << 21
_MIX = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: bytes, hashes: WordHashes, width: int) -> np.ndarray:
    """The distinct shingles of lower-case words, sorted; the whole sequence if it is shorter; none without words."""
    words = hashes.of(text.lower().split())
    if not len(words):
        return words
    return np.unique(runs(words, min(width, len(words))) + np.uint64(min(width, len(words))))


def set_key(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def linked(size_a: int, size_b: int, shared: int, percent: int) -> bool:
    return 100 * shared >= percent * (size_a + size_b - shared)


def prefix_length(size: int, percent: int) -> int:
    return size - -(-size * percent // 100) + 1


def subsets(size: int, percent: int) -> int:
    """How many subsets a light set of this size enumerates."""
    return sum(math.comb(size, i) for i in range(size - -(-size * percent // 100) + 1))


def boundary(counts: dict[int, int], percent: int, largest: int = 64) -> int:
    """The largest size that is light, by the bytes that either way moves for the sets of each size."""
    row, best, least = 24, 0, None
    for b in range(largest + 1):
        cost = sum(n * (subsets(s, percent) * row if s <= b else prefix_length(s, percent) * row + 2 * SKETCH + 16 * s) for s, n in counts.items() if s <= largest)
        if least is None or cost < least:
            best, least = b, cost
    return best


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * _MIX) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def rarity(docs: DataFrame, width: int) -> np.ndarray:
    """How many (document, shingle) pairs fall in each slot, over all documents."""
    size = SLOTS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = WordHashes(), np.zeros(SLOTS, np.uint32)
        for batch in batches:
            keys = np.concatenate([np.empty(0, np.uint64), *(shingles(t.as_py() or b"", hashes, width) for t in batch.column(0))])
            total += np.bincount(_slot(keys), minlength=SLOTS).astype(np.uint32)
        pack = zstandard.ZstdCompressor(level=1)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([pack.compress(total[i * size : (i + 1) * size].astype("<u8").tobytes()) for i in range(SLICES)], pa.binary())], ["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[at] = sums.get(at, 0) + np.frombuffer(unpack.decompress(packed), "<u8")
        pack = zstandard.ZstdCompressor(level=1)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([pack.compress(x.tobytes()) for x in sums.values()], pa.binary())], ["slice", "counts"])

    rows = docs.select("bytes").mapInArrow(count, "slice int, counts binary").repartition(SLICES, "slice").mapInArrow(add, "slice int, counts binary").collect()
    out = np.zeros(SLOTS, np.uint64)
    for at, packed in rows:
        out[at * size : (at + 1) * size] = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<u8")
    return out


def _looks_linked(sizes: np.ndarray, sketches: np.ndarray, i: int, js: np.ndarray, percent: int) -> np.ndarray:
    """Those of js whose difference from i is small enough by size and sketch."""
    js = js[100 * np.minimum(sizes[js], sizes[i]) >= percent * np.maximum(sizes[js], sizes[i])]
    if not len(js):
        return js
    apart = np.abs(sketches[js].astype(np.int16) - sketches[i].astype(np.int16)).sum(1)
    return js[(100 + percent) * apart <= (100 - percent) * (sizes[js] + sizes[i])]


def _emit(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Pairs as batches, the smaller id first."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])

    for a, b in found:
        out.append((np.minimum(a, b), np.maximum(a, b)))
        held += len(a)
        if held > 1 << 16:
            yield flush()
            out, held = [], 0
    if out:
        yield flush()


def _scan(keys: list[str], percent: int):
    """Pairs to compare from lists sorted by key: all that look linked from short lists, a forest of them from long ones."""

    def pairs_of(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = part.column("id").to_numpy(), part.column("n").to_numpy()
        sketches = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(len(ids), SKETCH)
        sides = part.column("side").to_numpy() if "side" in part.column_names else np.zeros(len(ids), int)
        across = sides.min() != sides.max()
        root = list(range(len(ids)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        forest = len(ids) > SHORT
        left, right = [], []
        for i in range(len(ids) - 1):
            js = np.arange(i + 1, len(ids))
            if across:
                js = js[sides[js] != sides[i]]
            js = _looks_linked(sizes, sketches, i, js, percent)
            if forest and len(js):
                kept = []
                for j in js.tolist():
                    x, y = find(i), find(j)
                    if x != y:
                        root[y] = x
                        kept.append(j)
                js = np.array(kept, np.int64)
            left.append(np.full(len(js), ids[i]))
            right.append(ids[js])
        return np.concatenate(left), np.concatenate(right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _emit(pairs_of(part) for part in groups(batches, keys) if part.num_rows > 1)

    return run


def joining_links(sets: list[np.ndarray], parts: np.ndarray, sides: np.ndarray, percent: int) -> tuple[list[int], list[int]]:
    """Links between sets of different parts, as few as join all parts that have any; of two sides only those across.

    Sets are named by numbers, and one set's numbers are looked up in all others at once.
    """
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(names), np.int32)
    _, label = np.unique(parts, return_inverse=True)
    across = sides.min() != sides.max()
    left, right = [], []
    for i in range(len(sets) - 1):
        fit = label[i + 1 :] != label[i]
        fit &= 100 * np.minimum(sizes[i + 1 :], sizes[i]) >= percent * np.maximum(sizes[i + 1 :], sizes[i])
        if across:
            fit &= sides[i + 1 :] != sides[i]
        js = i + 1 + np.flatnonzero(fit)
        if not len(js):
            continue
        own = flat[ends[i] - sizes[i] : ends[i]]
        mark[own] = 1
        shared = np.add.reduceat(mark[np.concatenate([flat[ends[j] - sizes[j] : ends[j]] for j in js.tolist()])], np.cumsum(sizes[js]) - sizes[js])
        mark[own] = 0
        for j in js[100 * shared >= percent * (sizes[i] + sizes[js] - shared)].tolist():
            if label[j] != label[i]:
                left.append(i)
                right.append(j)
                label[label == label[j]] = label[i]
    return left, right


def _join_parts(keys: list[str], percent: int):
    """Links that join the parts of families, from blocks sorted by key."""

    def links_of(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        sets = [unsqueeze(e) for e in part.column("elements").to_pylist()]
        left, right = joining_links(sets, part.column("component").to_numpy(), part.column("side").to_numpy(), percent)
        ids = part.column("id").to_numpy()
        return ids[left], ids[right]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _emit(links_of(part) for part in groups(batches, keys) if part.num_rows > 1)

    return run


def _labelled(docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """jaccard_components, and mark, a hash of the text, and part, which names the component; part is null without shingles.

    Only these labels stay in the shared folder; the sets, lists and links behind them are removed.
    """
    with working(docs.sparkSession):
        return stored(_label(docs, percent, width, id_col, text_col), "labelled", keep=True)


def _label(docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    work = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("bytes"))
    work = work.withColumn("mark", F.xxhash64("bytes"))
    common = spark.sparkContext.broadcast(rarity(work, width))  # SLOTS numbers

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, keys, sketches, prefixes, light = [], [], [], [], []
            for text in batch.column(1):
                own = shingles(text.as_py() or b"", hashes, width)
                n = len(own)
                sizes.append(n)
                keys.append(set_key(own) if n else None)
                # Capping a count can only bring two sketches closer.
                sketches.append(np.minimum(np.bincount((own % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH), 255).astype(np.uint8).tobytes())
                prefixes.append(own[np.lexsort((own, common.value[_slot(own)]))[: prefix_length(n, percent)]].astype(np.int64) if n else np.empty(0, np.int64))
                light.append(own.astype(np.int64) if n <= 64 else np.empty(0, np.int64))

            def lists(x: list[np.ndarray]) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(y) for y in x])]).astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int64), *x])))

            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()), lists(prefixes), lists(light), batch.column(2)],
                ["doc_id", "n", "key", "sketch", "prefix", "light", "mark"])

    described = stored(work.mapInArrow(describe, "doc_id bigint, n bigint, key binary, sketch binary, prefix array<bigint>, light array<bigint>, mark bigint"), "shingle-sets")
    classes = described.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("id"))
    classes = stored(classes, "shingle-classes")
    # Of rows that repeat an id with one text, one stands for the class; a null id stands for those without any other.
    heads = described.join(classes, [described["key"] == classes["key"], described["doc_id"].eqNullSafe(classes["id"])], "left_semi").dropDuplicates(["key"])
    heads = stored(heads.select(F.xxhash64("key").alias("id"), "n", "sketch", "prefix", "light", F.col("doc_id").alias("first"), "mark", "key"), "shingle-heads")
    counts = {r[0]: r[1] for r in heads.where("n <= 64").groupBy("n").count().collect()}
    edge = boundary(counts, percent)

    def enumerate_subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, ids, ns, cs = [], [], [], []
            np.seterr(over="ignore")  # arithmetic modulo 2**64 is meant
            for key, n, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                mixed = (np.array(own, np.int64).astype(np.uint64) ^ np.uint64(0xA0761D6478BD642F)) * _MIX
                mixed ^= mixed >> np.uint64(31)
                whole = mixed.sum(dtype=np.uint64)
                for drop in range(n - -(-n * percent // 100) + 1):
                    for gone in combinations(range(n), drop):
                        sig = whole - mixed[list(gone)].sum(dtype=np.uint64) if gone else whole
                        sigs.append(((sig * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(n - drop)).astype(np.int64))
                        ids.append(key)
                        ns.append(n)
                        cs.append(n - drop)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (sigs, ids, ns, cs)], ["sig", "id", "n", "c"])

    light = heads.where(F.col("n") <= edge).select("id", "n", "light").mapInArrow(enumerate_subsets, "sig bigint, id bigint, n bigint, c bigint")
    light = stored(light, "shingle-subsets")
    # Of the sets that share a subset the smallest links with every one that links with any.
    least = light.groupBy("sig", "c").agg(F.min(F.struct("n", "id")).alias("m"), F.count("*").alias("k")).where("k > 1")
    light_links = light.join(least, ["sig", "c"]).where((F.col("id") != F.col("m.id")) & (100 * F.col("c") >= percent * (F.col("n") + F.col("m.n") - F.col("c")))).select(F.col("id").alias("a"), F.col("m.id").alias("b"))

    heavy = heads.where(100 * F.col("n") >= percent * (edge + 1))
    posted = stored(heavy.select("id", F.explode("prefix").alias("sig")), "shingle-lists")
    crowds = posted.groupBy("sig").agg(F.count("*").alias("crowd")).where("crowd > 1")
    lists = stored(posted.join(crowds, "sig").join(heavy.select("id", "n", "sketch"), "id"), "shingle-crowds")
    by_size = ["n", "id"]
    short = lists.where(F.col("crowd") <= SHORT).select("sig", "id", "n", "sketch").repartition("sig").sortWithinPartitions("sig", *by_size)

    def in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
        """Every row once for each pair of blocks that its own takes part in."""
        rows = rows.withColumn("side", F.pmod(F.xxhash64("id"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        return rows.withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")}).drop("other")

    long = in_blocks(lists.where(F.col("crowd") > SHORT), F.ceil(F.col("crowd") / BLOCK)).select("sig", "low", "high", "side", "id", "n", "sketch")
    tile = ["sig", "low", "high"]
    forests = stored(long.repartition(*tile).sortWithinPartitions(*tile, *by_size).mapInArrow(_scan(tile, percent), "a bigint, b bigint"), "shingle-forests")

    def checked(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Those of the pairs that are linked, by comparing their sets in full, and the sets."""
        pairs = stored(pairs.distinct(), "shingle-pairs")
        needed = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        texts = heads.join(needed, "id", "left_semi").select("id", F.col("key").alias("head"), "first", F.col("mark").alias("first_mark"))

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in batches:
                sets_of = [shingles(t.as_py() or b"", hashes, width) for t in batch.column(1)]
                # A row that repeats the id with another text is told by its key, the hash of its elements.
                same = pa.array([set_key(own) == head.as_py() for own, head in zip(sets_of, batch.column(2), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(squeeze, sets_of), pa.binary())], ["id", "elements"]).filter(same)

        one = work["doc_id"].eqNullSafe(texts["first"]) & (work["mark"] == texts["first_mark"])
        found = work.join(texts, one).select("id", "bytes", "head").mapInArrow(sets, "id bigint, elements binary")
        found = stored(found, "compared-sets").dropDuplicates(["id", "elements"])
        both = pairs.join(found.select(F.col("id").alias("a"), F.col("elements").alias("x")), "a").join(found.select(F.col("id").alias("b"), F.col("elements").alias("y")), "b")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                    x, y = unsqueeze(x.as_py()), unsqueeze(y.as_py())
                    keep.append(linked(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), percent))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return both.select("a", "b", "x", "y").mapInArrow(compare, "a bigint, b bigint"), found

    heavy_links, sets_of = checked(short.mapInArrow(_scan(["sig"], percent), "a bigint, b bigint").union(forests))
    links = stored(light_links.union(heavy_links), "links")
    reached = components(links, "first-components")
    if not forests.isEmpty():
        family = components(forests, "families").select(F.col("node").alias("id"), F.col("component").alias("family"))
        known = family.join(reached.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        known = known.join(heads.select("id", "n"), "id")
        apart = known.groupBy("family").agg(F.min("component").alias("l"), F.max("component").alias("m"), F.count("*").alias("members"), F.sum("n").alias("total"))
        apart = apart.where("l <> m").select("family", F.ceil(F.greatest(F.col("members") / BLOCK, F.col("total") / ELEMENTS)).alias("blocks"))
        block = ["family", "low", "high"]
        rows = in_blocks(known.join(apart, "family"), F.col("blocks")).join(sets_of, "id").select(*block, "side", "id", "n", "component", "elements")
        rows = rows.repartition(*block).sortWithinPartitions(*block, *by_size)
        links = stored(links.union(rows.mapInArrow(_join_parts(block, percent), "a bigint, b bigint")), "all-links")
        reached = components(links, "components")
    firsts = reached.join(heads.select("id", "first"), F.col("node") == F.col("id")).groupBy("component").agg(F.min("first").alias("component_id"))
    named = reached.join(firsts, "component").select(F.col("node").alias("id"), "component", "component_id")
    per_key = heads.join(named, "id", "left").select(F.col("key").alias("head"), F.coalesce("component_id", "first").alias("component_id"), F.coalesce("component", "id").alias("part"))
    out = described.select("doc_id", "n", "key", "mark").join(per_key, F.col("key") == F.col("head"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "mark", "part")


def jaccard_components(
    docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id, the smallest id that links reach, itself included.

    Two documents are linked when 100 * shared >= percent * (size of the union of their shingle sets). A null text, or one
    without words, has no shingles and links with nothing. A row with a null id is a document like others; a component
    of null ids only has a null id. Rows that repeat an id each count as documents. An empty table gives no rows. Ids are whole numbers;
    shingles are told apart by 64-bit hashes.
    """
    return _labelled(docs, percent, width, id_col, text_col).drop("mark", "part")


def keep_one(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents less all but one of each component, the one with the smallest id; columns are carried by place.

    Of texts that share the smallest id one stays, the one with the least hash. Another text of an id that goes is judged
    by itself. A null id counts as the largest. Rows that repeat an id and its text become one. Texts without words all stay.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = F.col(f"c{names.index(id_col)}"), F.col(f"c{names.index(text_col)}")
    found = _labelled(plain, percent, width, f"c{names.index(id_col)}", f"c{names.index(text_col)}")
    found = found.where("n_shingles > 0").select("doc_id", "mark", "part")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark"))
    first = found.groupBy("part").agg(least.alias("first"), F.count("*").alias("members")).where("members > 1")
    gone = found.join(first, "part").where(~F.col("doc_id").eqNullSafe(F.col("first.doc_id")) | (F.col("mark") != F.col("first.mark")))
    gone = gone.select(F.col("doc_id").alias("gone"), F.col("mark").alias("gone_mark")).distinct()
    wordless = ~F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rest = plain.where(~wordless).withColumn("mark", F.xxhash64(text.cast("binary")))
    rest = rest.join(gone, key.eqNullSafe(F.col("gone")) & (F.col("mark") == F.col("gone_mark")), "left_anti")
    return plain.where(wordless).union(rest.dropDuplicates([f"c{names.index(id_col)}", "mark"]).drop("mark")).toDF(*names)
