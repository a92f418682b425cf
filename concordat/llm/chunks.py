"""Whole texts to token ids by way of their white-space separated chunks, each encoded once while it stays in the cache."""

from __future__ import annotations

import functools
import json
import os
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Chunks, and words, kept before a cache starts anew: some 100 MB in a worker.
CACHE_LIMIT = 400_000
ID_BYTES = array("I").itemsize
#: Bytes of text cut at a time; a longer text is cut alone.
SLICE_BYTES = 1 << 20
#: Words handed to the library in one call: its cost a word rises with the length of what it is given.
CALL_WORDS = 200
#: A text may be put in lower case before it is cut if no mark could join a letter (they start at U+0300) and it holds no
#: special token.
_LATER = r"<\||[^\x00-\x{2FF}]"


def packed(ids: Sequence[int]) -> bytes:
    """Ids as unsigned 32-bit integers: a cache of them has no object for each id."""
    return array("I", ids).tobytes()


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in order, so many at a time as SLICE_BYTES hold, one at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, "right")))
        yield texts.slice(at, end - at)
        at = end


class ChunkEncoder:
    """Encodes texts for tokenizers whose tokens never span white space.

    Texts are cut at ASCII white space and their distinct chunks looked up; encode_chunks maps new chunks to their ids, each
    chunk's as packed gives them. Ids live in one flat array; the ids of texts are a gather over their chunks.
    """

    def __init__(self, encode_chunks: Callable[[list[str]], list[bytes]], lower_case: bool = False, limit: int = CACHE_LIMIT):
        self._encode, self._lower_case, self._limit = encode_chunks, lower_case, limit
        self._reset()

    def _reset(self) -> None:
        self._place: dict[str, int] = {}
        self._flat, self._used = np.empty(1 << 16, np.uint32), 0
        self._start, self._length = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def _learn(self, new: list[str]) -> None:
        ids = self._encode(new)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // ID_BYTES
        flat = np.frombuffer(b"".join(ids), np.uint32)
        at, used = len(self._place), self._used
        while used + len(flat) > len(self._flat):
            self._flat = np.concatenate([self._flat, np.empty_like(self._flat)])
        while at + len(new) > len(self._start):
            self._start = np.concatenate([self._start, np.empty_like(self._start)])
            self._length = np.concatenate([self._length, np.empty_like(self._length)])
        self._flat[used : used + len(flat)] = flat
        self._start[at : at + len(new)] = used + np.cumsum(lengths) - lengths
        self._length[at : at + len(new)] = lengths
        self._used += len(flat)
        self._place.update(zip(new, range(at, at + len(new))))

    def _places(self, chunks: list[str]) -> np.ndarray:
        """Where each of the distinct chunks is kept."""
        if len(self._place) > self._limit:
            self._reset()
        at = np.fromiter(map(self._place.get, chunks, repeat(-1)), np.int64, len(chunks))
        if len(missing := np.flatnonzero(at < 0)):
            known = len(self._place)
            self._learn(list(map(chunks.__getitem__, missing.tolist())))
            at[missing] = np.arange(known, known + len(missing))
        return at

    def encode_slice(self, texts: pa.Array) -> list[np.ndarray]:
        """Token ids of each text, as unsigned 32-bit integers; a null text counts as empty."""
        texts = pc.fill_null(texts, "")
        if self._lower_case:
            texts = pc.if_else(pc.match_substring_regex(texts, _LATER), texts, pc.ascii_lower(texts))  # fewer chunks differ
        cut = pc.ascii_split_whitespace(texts)
        coded = cut.flatten().dictionary_encode()
        at = self._places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        lengths = self._length[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self._flat[np.repeat((self._start[at] - ends[:-1]).astype(np.int32), lengths) + np.arange(ends[-1], dtype=np.int32)]
        return np.split(ids, ends[cut.offsets.to_numpy()[1:-1]])

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Token ids of each text; memory holds those of one slice."""
        for part in slices(texts):
            yield from self.encode_slice(part)

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_slice(pa.array([text], pa.string()))[0]


class WordSplitter:
    """The normalising and splitting that a word-end vocabulary file asks for: composed, lower case, cut by its pattern."""

    def __init__(self, spec: dict):
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        (pattern,) = (p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._word = regex.compile(pattern)
        names = sorted(self.special, key=len, reverse=True)
        self._cut = regex.compile("|".join(map(regex.escape, names)) or r"(?!)")

    def words(self, chunk: str) -> list[str]:
        """Words of a chunk without special tokens."""
        if not chunk.isascii():
            # Lower-casing is per character: no special form of sigma at the end of a word.
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        chunk = chunk.lower()
        if chunk.isalpha():
            return [chunk]
        if chunk[-1:] in (".", ",") and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self._word.findall(chunk)

    def pieces(self, chunk: str) -> list[str | int]:
        """Words and ids of special tokens, in order."""
        if "<" not in chunk or not (found := list(self._cut.finditer(chunk))):
            return self.words(chunk)
        out: list[str | int] = []
        at = 0
        for hit in found:
            out += self.words(chunk[at : hit.start()])
            out.append(self.special[hit[0]])
            at = hit.end()
        return out + self.words(chunk[at:])


class WordEncoder:
    """Ids of chunks by way of a cache of words; encode_words gives the ids of new words."""

    def __init__(self, splitter: WordSplitter, encode_words: Callable[[list[str]], Iterable[list[int]]]):
        self._pieces, self._encode = splitter.pieces, encode_words
        self._words: dict[str | int, bytes] = {}

    def __call__(self, chunks: list[str]) -> list[bytes]:
        pieces = self._pieces
        cut = [(c,) if c.isascii() and c.isalpha() and c.islower() else pieces(c) for c in chunks]
        if len(self._words) > CACHE_LIMIT:
            self._words = {}
        known = self._words
        new = [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in known]
        words = [p for p in new if isinstance(p, str)]
        known.update((p, packed([p])) for p in new if not isinstance(p, str))
        known.update(zip(words, map(packed, self._encode(words)), strict=True))
        return [known[pieces[0]] if len(pieces) == 1 else b"".join(map(known.__getitem__, pieces)) for pieces in cut]


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself when it is a visible Latin-1 character, else the next above U+00FF."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@functools.lru_cache(maxsize=1)
def library_encoder(vocabulary_json: str) -> ChunkEncoder:
    """The tokenizers library behind a chunk cache; without truncation and padding, which a file may ask for.

    A Python worker keeps it, so that its next task neither parses the file nor encodes known words again. New words go to
    the library together, parted by spaces: a word ends with the one token that carries the suffix.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer, pre_tokenizers

    spec = json.loads(vocabulary_json) | {"truncation": None, "padding": None}
    suffix = spec["model"].get("end_of_word_suffix")
    if not suffix:
        tokenizer = Tokenizer.from_str(json.dumps(spec))
        return ChunkEncoder(lambda new: [packed(tokenizer.encode(x, add_special_tokens=False).ids) for x in new])
    vocab = spec["model"]["vocab"]
    # Words are normalised, cut and spelled in byte symbols already.
    tokenizer = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}))
    tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    symbols = {byte: symbol for byte, symbol in enumerate(byte_symbols()) if byte != ord(" ")}
    closes = np.zeros(max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1, bool)
    closes[[i for label, i in vocab.items() if label.endswith(suffix)]] = True

    def ids_of(words: list[str]) -> list[int]:
        (found,) = tokenizer.encode_batch_fast([" ".join(words).encode().decode("latin-1").translate(symbols)], add_special_tokens=False)
        return found.ids

    def encode_words(words: list[str]) -> Iterator[list[int]]:
        for at in range(0, len(words), CALL_WORDS):
            some = words[at : at + CALL_WORDS]
            ids = ids_of(some)
            ends = (np.flatnonzero(closes[ids]) + 1).tolist()
            if len(ends) == len(some):
                yield from (ids[a:b] for a, b in zip([0, *ends], ends, strict=False))
            else:
                yield from (ids_of([w]) for w in some)

    return ChunkEncoder(WordEncoder(WordSplitter(spec), encode_words), lower_case=True)
