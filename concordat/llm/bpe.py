"""BPE encoding and decoding with a tokenisation automaton compiled from the merge list.

The automaton starts as one state with an arc per base symbol. Merges are compiled in order. For merge (u, v) the gadget
gives the target of the u arcs a copy without the arc v, sends the u arcs to that copy, and adds the arc uv from every
source of u to where v led. A state is therefore known by the last arc taken, and its arcs are those of the start state
less the ones its gadgets removed. Only the removed arcs are stored, each with the step that removed it:

* after arc t = (u, v), made at step r, the state is a copy of the one after v as it was at step r;
* an arc t = (u, v) leaves a state only if that state still had the arc u at step r.

Every prefix of a word has exactly one path, so encoding is one deterministic pass that keeps one arc per position.
Decoding emits the arc labels.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from concordat.llm.chunks import ChunkEncoder, WordEncoder, WordSplitter, byte_symbols
from concordat.llm.shared import vocabulary

#: Transitions that the table keeps before it is filled anew.
MEMORY_LIMIT = 500_000


class Automaton:
    """Arcs of the compiled automaton. An arc is a token id; its label is the token's text."""

    def __init__(self, ids: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.labels = [""] * (max(ids.values(), default=-1) + 1)
        for label, token in ids.items():
            self.labels[token] = label
        self._made: dict[int, tuple[int, int, int]] = {}
        self._removed: dict[int, dict[int, int]] = {}
        base = {c: ids[c] for c in {*"".join(ids)} if c in ids}
        self._trie: list = [{}, -1, -1]
        for symbol, arc in base.items():
            self._spell(symbol, suffix, arc, ids.get(symbol + suffix, -1) if suffix else arc)
        for step, (left, right) in enumerate(merges):
            self._gadget(step, ids[left], ids[right], ids[left + right])
            inner = left + right
            if not suffix:
                self._spell(inner, suffix, ids[inner], ids[inner])
            elif inner.endswith(suffix):
                self._spell(inner.removesuffix(suffix), suffix, None, ids[inner])
            else:
                self._spell(inner, suffix, ids[inner], None)
        self._table: dict[int, dict[int, bool]] = {}
        self._filled = 0

    def _gadget(self, step: int, u: int, v: int, uv: int) -> None:
        """Take the arc v from the state after u, and add the arc uv."""
        self._removed.setdefault(u, {}).setdefault(v, step)
        self._made.setdefault(uv, (step, u, v))

    def _spell(self, symbols: str, suffix: str, inner: int | None, final: int | None) -> None:
        """Enter an arc under the symbols that its label spells, within a word or at its end."""
        node = self._trie
        for symbol in symbols:
            node = node[0].setdefault(symbol, [{}, -1, -1])
        if inner is not None:
            node[1] = inner
        if final is not None:
            node[2] = final

    def _has(self, last: int, arc: int) -> bool:
        """Whether the state after the arc last still has arc."""
        state, copied = last, None
        while True:
            if gone := self._removed.get(state):
                first, added = arc, None
                while True:
                    step = gone.get(first)
                    if step is not None and (copied is None or step < copied) and (added is None or step <= added):
                        return False
                    if first not in self._made:
                        break
                    added, first, _ = self._made[first]
            if state not in self._made:
                return True
            copied, _, state = self._made[state]

    def encode_word(self, symbols: str) -> list[int]:
        """Arcs of the only path that spells the word; its last symbol carries the suffix."""
        size = len(symbols)
        arc_to, came = [-1] * (size + 1), [0] * (size + 1)
        if self._filled > MEMORY_LIMIT:
            self._table, self._filled = {}, 0
        for start in range(size):
            last = arc_to[start]
            if start and last < 0:
                continue
            row = self._table.get(last)
            if row is None:
                row = self._table[last] = {}
            node = self._trie
            for end in range(start + 1, size + 1):
                node = node[0].get(symbols[end - 1])
                if node is None:
                    break
                arc = node[2] if end == size else node[1]
                if arc < 0 or arc_to[end] >= 0:
                    continue
                ok = row.get(arc)
                if ok is None:
                    ok = row[arc] = not start or self._has(last, arc)
                    self._filled += 1
                if ok:
                    arc_to[end], came[end] = arc, start
        if size and arc_to[size] < 0:
            raise ValueError(f"no path spells {symbols!r}")
        path = []
        while size:
            path.append(arc_to[size])
            size = came[size]
        return path[::-1]

    def decode(self, ids) -> str:
        """Arc labels joined by a space, as the library joins tokens when a vocabulary names no decoder."""
        return " ".join(map(self.labels.__getitem__, ids))


class BpeTokenizer:
    """Normalises, splits into words and encodes with the automaton, as the vocabulary file states."""

    def __init__(self, vocabulary_json: str):
        spec = json.loads(vocabulary_json)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        splitter = WordSplitter(spec)
        labels = self.automaton.labels
        labels += [""] * (max(splitter.special.values(), default=-1) + 1 - len(labels))
        for label, token in splitter.special.items():
            labels[token] = label
        symbol = dict(enumerate(byte_symbols()))
        encode = self.automaton.encode_word
        self._chunks = ChunkEncoder(WordEncoder(splitter, lambda words: (encode(w.encode().decode("latin-1").translate(symbol)) for w in words)), lower_case=True)

    def encode(self, text: str | None):
        return self._chunks.encode(text)

    def encode_all(self, texts: pa.Array):
        return self._chunks.encode_all(texts)

    def decode(self, ids) -> str:
        return self.automaton.decode(ids)


@functools.lru_cache(maxsize=1)
def tokenizer_of(vocabulary_json: str) -> BpeTokenizer:
    """The compiled tokenizer, which a Python worker keeps for its next task."""
    return BpeTokenizer(vocabulary_json)


def encode_documents(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Encode every whole text, decode it again, and digest both.

    Returns doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space) and decoded_sha256; with_ids adds the
    ids and the decoded text. A null text counts as empty; a null id stays null; repeated rows give repeated rows; an
    empty table gives no rows; other columns are not read. Nothing is shuffled: each task encodes what it scans.
    """
    vocab = vocabulary(docs.sparkSession, vocabulary_path)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(vocab.value)
        decimal = [str(i) for i in range(len(tokenizer.automaton.labels))]
        for batch in batches:
            counts, ids_sha, text_sha, all_ids, texts = [], [], [], [], []
            for found in tokenizer.encode_all(batch.column(1)):
                ids = found.tolist()
                decoded = tokenizer.decode(ids)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    all_ids.append(ids)
                    texts.append(decoded)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_col, text_col).mapInArrow(run, schema + (", ids array<int>, decoded string" if with_ids else ""))
