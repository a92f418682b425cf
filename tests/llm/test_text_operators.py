"""The text operators on small tables, against brute force and the tokenizers library."""

import hashlib
import json
import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import combinations, product
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from concordat.llm import jaccard, packing, quality, substring_dedup, token_files
from concordat.llm.bpe import BpeTokenizer, encode_documents
from concordat.llm.chunks import ChunkEncoder, WordEncoder, WordSplitter, library_encoder
from concordat.llm.embed_dedup import near_embeddings
from concordat.llm.jaccard import jaccard_components, keep_one
from concordat.llm.langid import keep_languages, predict_languages
from concordat.llm.packing import pack_documents
from concordat.llm.ppm import ORDER, language_model_scores
from concordat.llm.quality import quality_rules
from concordat.llm.shared import scratch
from concordat.llm.substring_dedup import drop_repeats, duplicate_spans
from concordat.llm.token_files import token_files as write_and_read
from concordat.llm.url_rules import filter_urls, mine_rules

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CONTENT = open(VOCABULARY, encoding="utf-8").read()
LIBRARY = Tokenizer.from_str(CONTENT)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, kept string, rest string, block string"


def sentence(seed: int, count: int, lang: str = "en") -> str:
    r = random.Random(f"{lang}{seed}")
    syllables = {"en": "the ing er on an re".split(), "fr": "é ou eau ment que la".split()}[lang]
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(count))


SHARED = sentence(1000, 30)
TEXTS = [
    (1, sentence(1, 120)), (2, sentence(1, 120)), (3, sentence(1, 118) + " odd end"), (4, SHARED + " " + sentence(4, 60)),
    (5, sentence(5, 40) + "\n" + SHARED + "\n" + sentence(6, 9)), (6, None), (7, ""), (8, "   \n\t"), (9, "..., !!"),
    (10, "one"), (11, "one"), (12, "one two"), (13, sentence(13, 3000)), (None, sentence(14, 50)), (None, None), (None, sentence(1, 120)),
    (15, sentence(15, 15)), (16, sentence(15, 14) + " last"), (17, "Ünï <|endoftext|> 'S 日本 <|x"), (18, sentence(18, 80, "fr")),
    (19, sentence(19, 70, "fr")), (20, " ".join(["spam eggs"] * 60)), (21, "### " * 50 + sentence(21, 10)), (5, sentence(5, 40)), (5, sentence(5, 40)),
]


def rows_of(texts):
    return [(i, t, "fr" if t and "eau" in t else "en", "s", len(t or ""), "x", "y", "z", "w") for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(TEXTS), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_automaton_and_chunks_encode_like_the_library():
    r = random.Random(3)
    own, cached = BpeTokenizer(CONTENT), library_encoder(CONTENT)
    letters = "aaaaeiotn'strelld \xa0\x85\u2028\u0331\u0307HIJé 0123.,!?éΣİ\n\tßẞ日本語́\x1cA<|>"
    for i in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 40))) + ("<|endoftext|>" if i % 50 == 0 else "")
        wanted = LIBRARY.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == wanted == cached.encode(text).tolist()
        assert own.decode(wanted) == LIBRARY.decode(wanted, skip_special_tokens=False)


def test_encoding_digests(docs, empty):
    got = Counter(tuple(r) for r in encode_documents(docs, VOCABULARY).collect())
    wanted = Counter()
    for i, t in TEXTS:
        ids = ids_of(t)
        wanted[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert got == wanted
    assert encode_documents(empty, VOCABULARY).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17, 32])
def test_packed_bits_round_trip_and_random_access(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001).astype(np.uint32)
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-1001 * bits // 8)
    assert (token_files.unpack(packed, bits, 0, 1001) == ids).all()
    assert (token_files.unpack(packed, bits, 333, 50) == ids[333:383]).all()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(docs, empty):
    rows = write_and_read(docs, VOCABULARY, end_id=1).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in rows) == Counter((i, crc([*ids_of(t), 1])) for i, t in TEXTS)
    assert write_and_read(empty, VOCABULARY).count() == 0


def test_differencing_balances():
    r = random.Random(1)
    sizes = [r.randint(1, 500) for _ in range(300)]
    split = packing.differencing(sizes, 20)
    sums = [sum(sizes[i] for i in w) for w in split]
    assert sorted(i for w in split for i in w) == list(range(300)) and max(sums) - min(sums) < 0.02 * max(sums)


def test_packing(docs, empty):
    rows = pack_documents(docs, VOCABULARY, 64, 2, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert crc(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and at & (at - 1) == 0  # full or a power of two: nothing to pad
    assert sum(r["length"] for r in rows) == sum(len(ids_of(t)) + 1 for _, t in TEXTS)
    for (_, tokens), parts in pieces.items():
        assert sum(n for _, n in parts) % tokens == 0
    assert pack_documents(empty, VOCABULARY).count() == 0


def test_ids_of_pieces_make_no_objects():
    parts = [np.arange(i, i + 100_000, dtype=np.uint32) for i in range(5)] + [np.empty(0, np.uint32)]
    tracemalloc.start()
    lists = packing.id_lists(parts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lists.to_pylist() == [p.tolist() for p in parts] and lists.type == pa.list_(pa.int32())
    assert peak < 2 * sum(p.nbytes for p in parts)


def test_cached_ids_make_no_objects():
    words = ["".join(w) for w in product("abcdefghijklmnopqrst", repeat=4)][:20_000]
    place = {w: 70_000 + i for i, w in enumerate(words)}
    words_of = WordEncoder(WordSplitter(json.loads(CONTENT)), lambda some: ([place[w], place[w] + 1, place[w] + 2] for w in some))
    tracemalloc.start()
    found = words_of(words)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(found) == len(words)
    assert held < 120 * len(words)
    ids = ChunkEncoder(words_of).encode(" ".join(words[:500]))
    assert ids.tolist() == [place[w] + i for w in words[:500] for i in range(3)]


def test_languages(docs, empty):
    rows = predict_languages(docs, per_language=50, landmarks=20).collect()
    assert len(rows) == len(TEXTS)
    said = {r["doc_id"]: r for r in rows}
    assert {i: said[i]["lang_pred"] for i in (1, 4, 18, 19, 7, 8, 9)} == {1: "en", 4: "en", 18: "fr", 19: "fr", 7: "und", 8: "und", 9: "und"}
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    kept = keep_languages(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, _ in TEXTS} - {6, 7, 8, 9}
    assert predict_languages(empty).count() == 0 and keep_languages(empty).columns == empty.columns


def test_language_decisions_take_effect(spark):
    r = random.Random(8)
    syllables = {
        "en": "the ing er on an re", "fr": "é ou eau ment que la", "de": "sch ung ein ü der ich", "es": "ción ñ os el rr ado", "fi": "kk ää yt uo jä nn",
    }

    def text(lang):
        return " ".join("".join(r.choice(syllables[lang].split()) for _ in range(r.randint(1, 4))) for _ in range(60))

    rows = [(k, text(lang), lang) for k, lang in enumerate(["en", "fr", "de", "es"] * 40)]
    noise = {
        1000: text("fi"), 1001: text("fi"), 1002: "| 12 | 7 | x |\n" * 40, 1003: '<td class="q1">77</td>' * 30,
        1004: " ".join(f"{r.getrandbits(64):x}" for _ in range(60)), 1005: "быстрая лиса бежит домой " * 8, 1006: None, 1007: "12 ...",
    }
    frame = spark.createDataFrame([*rows, *((i, t, None) for i, t in noise.items())], "doc_id long, text string, lang string").repartition(3)
    assert Counter(r["doc_id"] for r in keep_languages(frame).collect()) == Counter(i for i, *_ in rows)
    assert {r["doc_id"] for r in keep_languages(frame, ["fr", "es"]).collect()} == {i for i, _, lang in rows if lang in ("fr", "es")}
    assert Counter(r["doc_id"] for r in corpus_pipeline.language(spark, frame, "").collect()) == Counter(i for i, *_ in rows)


def brute_measures(text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if x.strip()]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality(docs, empty):
    rows = quality_rules(docs).collect()
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows)
    assert got == Counter((i, *brute_measures(t)) for i, t in TEXTS)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert kept[1] and kept[13] and not kept[20] and not kept[21]
    assert quality_rules(empty).count() == 0


def test_label_model_spares_good_and_finds_rare_junk():
    good = quality.votes(quality.measure(sentence(1, 100).encode())[1])
    junk = quality.votes(quality.measure(("a$$$ " * 3 + sentence(2, 20).replace(" ", "### ")).encode())[1])
    post = quality.label_model({good: 9000, junk: 200})
    assert post[good] > 0.9 and post[junk] < 0.5


def pattern_of(bad=(), silent=()):
    return sum((1 if k in bad else 0 if k in silent else 2) * 3**k for k in range(len(quality.RULES)))


def brute_posterior(counts, rounds=300):
    """The label model in loops over rows of the corpus, one rule at a time."""
    total, rules = sum(counts.values()), range(len(quality.RULES))
    cast = {p: [p // 3**k % 3 for k in rules] for p in counts}
    good = {p: 0.05 if 1 in v else 0.95 for p, v in cast.items()}
    (w_bad, m_bad), (w_good, m_good), (w_base, m_base) = quality.BELIEF
    for _ in range(rounds):
        rates = []
        for weight, mean, part in ((w_bad, m_bad, lambda p: 1 - good[p]), (w_good, m_good, lambda p: good[p])):
            rates.append([])
            for k in rules:
                said = sum(n * part(p) for p, n in counts.items() if cast[p][k] == 1) + weight * mean * total
                rates[-1].append(said / (sum(n * part(p) for p, n in counts.items() if cast[p][k]) + weight * total))
        base = (sum(n * (1 - good[p]) for p, n in counts.items()) + w_base * m_base * total) / (total * (1 + w_base))
        for p in counts:
            odds = [base, 1 - base]
            for c in (0, 1):
                for k in rules:
                    odds[c] *= {0: 1, 1: rates[c][k], 2: 1 - rates[c][k]}[cast[p][k]]
            good[p] = odds[1] / sum(odds)
    return good


def test_label_model_outvotes_a_rule_that_stands_alone():
    counts = {pattern_of(): 8000, pattern_of({0}): 300, pattern_of({1, 2, 3}): 500, pattern_of({5, 11}): 400, pattern_of({5, 10, 11}, {0}): 300, pattern_of({0, 1, 2}): 20}
    post = quality.label_model(counts)
    wanted = brute_posterior(counts)
    assert all(abs(post[p] - wanted[p]) < 1e-6 for p in counts)
    assert post[pattern_of({0})] > 0.5 and post[pattern_of()] > 0.9
    assert all(post[p] < 0.5 for p in counts if p not in (pattern_of(), pattern_of({0})))
    larger = quality.label_model({p: 1000 * n for p, n in counts.items()})
    assert all(abs(larger[p] - post[p]) < 1e-6 for p in counts)


def test_quality_verdicts_against_plain_python(spark, docs):
    counted = Counter(quality.votes(quality.measure((t or "").encode())[1]) for _, t in TEXTS)
    wanted = brute_posterior(counted)
    assert len(counted) > 3
    verdicts = Counter()
    for i, t in TEXTS:
        n, *_, repeated = brute_measures(t)
        verdicts[i, n >= 20 and 100 * repeated <= 30 * n and wanted[quality.votes(quality.measure((t or "").encode())[1])] >= 0.5] += 1
    assert Counter((r["doc_id"], r["kept"]) for r in quality_rules(docs).collect()) == verdicts
    assert Counter(r[0] for r in quality.keep_good(docs).select("doc_id").collect()) == Counter(i for (i, kept), n in verdicts.items() if kept for _ in range(n))


def shingle_set(text, width):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)]) if words else frozenset()


def brute_components(texts, width, percent):
    sets = [(i, shingle_set(t, width)) for i, t in texts]
    label = list(range(len(sets)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                label[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return Counter((i, len(s), least.get(find(k), i)) for k, (i, s) in enumerate(sets))


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_jaccard(spark, width, percent):
    r = random.Random(5)
    texts = [t for t in TEXTS if t[0] != 5]
    for k in range(90):  # near copies around the threshold, in chains, of light and heavy sizes
        words = sentence(700 + k % 9, (12, 22, 60)[k % 3]).split()
        for _ in range(r.randint(0, 3)):
            words[r.randrange(len(words))] = f"edit{r.randrange(4)}"
        texts.append((100 + k, " ".join(words)))
    frame = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(5)
    assert Counter(tuple(x) for x in jaccard_components(frame, percent, width).collect()) == brute_components(texts, width, percent)


@pytest.mark.parametrize(("short", "block", "elements"), [(jaccard.SHORT, jaccard.BLOCK, jaccard.ELEMENTS), (4, 16, 900)], ids=["one block", "many blocks"])
def test_jaccard_long_lists(spark, monkeypatch, short, block, elements):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "ELEMENTS", elements)
    r = random.Random(6)
    texts = []
    for k in range(160):  # one group that makes lists longer than SHORT
        words = sentence(900, 60).split()
        for _ in range(k % 4):
            words[r.randrange(len(words))] = f"edit{k}x{r.randrange(99)}"
        texts.append((k, " ".join(words)))
    frame = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(4)
    assert Counter(tuple(x) for x in jaccard_components(frame, 90, 3).collect()) == brute_components(texts, 3, 90)


def test_joining_links_are_few_and_lose_no_part():
    r = np.random.default_rng(3)
    for _ in range(30):
        base = [r.choice(10**6, 40, replace=False).astype(np.uint64) for _ in range(2)]
        sets = [np.unique(np.concatenate([base[k % 2][r.random(40) < 0.97], r.integers(10**6, 10**7, r.integers(0, 3)).astype(np.uint64)])) for k in range(40)]
        parts, sides = r.integers(0, 12, 40), r.integers(0, 2, 40)
        left, right = jaccard.joining_links(sets, parts, sides, 90)

        def joined(pairs, parts=parts):
            label = parts.copy()
            for i, j in pairs:
                label[label == label[j]] = label[i]
            return [tuple(label == x) for x in label]

        every = [(i, j) for i in range(40) for j in range(40) if i != j and sides[i] != sides[j] and jaccard.linked(len(sets[i]), len(sets[j]), len(np.intersect1d(sets[i], sets[j])), 90)]
        assert joined(every) == joined(zip(left, right, strict=True))
        assert len(left) < len(set(parts.tolist())) and all((i, j) in every for i, j in zip(left, right, strict=True))


def test_one_of_each_group_stays(docs, empty):
    left = keep_one(docs)
    assert left.columns == docs.columns
    ids = Counter(r["doc_id"] for r in left.collect())
    assert ids[1] == 1 and not ids[2] and not ids[3] and ids[10] == 1 and not ids[11] and all(ids[i] == 1 for i in (6, 7, 8, 13))
    assert keep_one(empty).count() == 0


def test_null_ids_are_documents(spark, docs):
    left = Counter((i, t) for i, t, *_ in keep_one(docs).collect())
    assert not left[None, sentence(1, 120)] and left[1, sentence(1, 120)] == 1  # TEXTS holds it with a null id
    assert left[None, sentence(14, 50)] == 1 and left[None, None] == 1
    chain = sentence(6000, 60).split()  # 400 and 401 are linked only by a null id between them
    texts = [(400, " ".join(chain)), (None, " ".join([*chain[:-5], *"abcde"])), (401, " ".join([*"vwxyz", *chain[5:-5], *"abcde"]))]
    texts += [(None, sentence(6001, 60)), (None, sentence(6001, 60)), (None, sentence(6001, 59) + " odd"), (None, sentence(6002, 60)), (None, " "), (None, " ")]
    frame = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)
    assert Counter(tuple(x) for x in jaccard_components(frame, 80, 5).collect()) == brute_components(texts, 5, 80)
    left = Counter((i, t) for i, t, *_ in keep_one(frame).collect())
    assert left[400, texts[0][1]] == 1 and left[None, sentence(6002, 60)] == 1 and left[None, " "] == 2
    assert left[None, sentence(6001, 60)] + left[None, sentence(6001, 59) + " odd"] == 1 and sum(left.values()) == 5


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_ids_with_several_texts(spark, width, percent):
    texts = list(TEXTS)
    for k in range(60):  # each id has a near copy of a heavy text, and another text of its own
        words = sentence(800 + k % 4, 90).split()
        words[-1] = f"edit{k}"
        texts += [(200 + k, " ".join(words)), (200 + k, sentence(2000 + k, 90))]
    texts += [(5, sentence(4000, 70)), (4, sentence(4000, 70)), (300, sentence(5000, 90)), (300, sentence(5000, 89) + " odd")]
    frame = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(5)
    assert Counter(tuple(x) for x in jaccard_components(frame, percent, width).collect()) == brute_components(texts, width, percent)
    left = Counter((i, t) for i, t, *_ in keep_one(frame, percent, width).collect() if i is not None)
    assert left[4, sentence(4000, 70)] == 1 and not left[5, sentence(4000, 70)]
    assert left[5, sentence(5, 40)] == 1 and left[5, TEXTS[4][1]] == 1
    assert all(left[200 + k, sentence(2000 + k, 90)] == 1 for k in range(60))
    assert [sum(n for (i, t), n in left.items() if i == 200 + k) for k in range(60)] == [2] * 4 + [1] * 56
    assert sum(n for (i, _), n in left.items() if i == 300) == 1


def test_repeated_passages(docs, empty):
    rows = duplicate_spans(docs).collect()
    first = {}
    for i, t in sorted((i, t) for i, t in TEXTS if i is not None and t):
        w = t.split()
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    wanted = Counter()
    for i, t in TEXTS:
        w = (t or "").split()
        keep = [True] * len(w)
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                keep[k : k + 13] = [False] * 13
        left = [x for x, y in zip(w, keep, strict=True) if y]
        wanted[i, len(w), len(w) - len(left), hashlib.sha256(" ".join(left).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows) == wanted
    left = drop_repeats(docs)
    assert left.columns == docs.columns and left.count() == len(TEXTS)
    texts = {r["doc_id"]: r for r in left.collect()}
    assert texts[2]["text"] == "" and texts[2]["n_chars"] == 0 and texts[1]["text"] == TEXTS[0][1] and texts[4]["source"] == "s"
    assert duplicate_spans(empty).count() == 0


def test_keys_of_a_block_are_held_twice_at_most():
    keys = np.random.default_rng(1).integers(0, 1 << 62, 400_000, np.uint64)
    held = [keys[i : i + 1000].copy() for i in range(0, len(keys), 1000)] + [keys[:500].copy()]
    tracemalloc.start()
    found = substring_dedup.distinct(held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not held and (found == np.unique(keys)).all()
    assert peak < 2.2 * keys.nbytes


@pytest.mark.parametrize("kinds", [1, 40, 1 << 40])
def test_held_before_against_brute_force(kinds):
    keys = np.random.default_rng(2).integers(0, kinds, 600, np.uint64)
    rank = np.sort(np.random.default_rng(3).integers(0, 50, len(keys))).astype(np.int32)
    least = {}
    for k, r in zip(keys.tolist(), rank.tolist(), strict=True):
        least.setdefault(k, r)
    assert substring_dedup.held_before(keys, rank).tolist() == [least[k] < r for k, r in zip(keys.tolist(), rank.tolist(), strict=True)]
    assert not len(substring_dedup.held_before(keys[:0], rank[:0]))


def test_passages_in_many_blocks_and_parts(docs, monkeypatch):
    whole = Counter(map(str, drop_repeats(docs).collect()))
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 300)
    monkeypatch.setattr(substring_dedup, "PART_BYTES", 200)
    monkeypatch.setattr(substring_dedup, "PART_PIECES", 2)
    assert Counter(map(str, drop_repeats(docs).collect())) == whole


@pytest.mark.parametrize("stage", [corpus_pipeline.passages, corpus_pipeline.packing])
def test_stages_of_whole_texts_take_small_batches(spark, docs, stage):
    before = spark.conf.get(corpus_pipeline.ROWS)
    try:
        for given, wanted in ((10_000, corpus_pipeline.TEXT_ROWS), (0, corpus_pipeline.TEXT_ROWS), (3, 3)):
            spark.conf.set(corpus_pipeline.ROWS, given)
            stage(spark, docs, "")
            assert int(spark.conf.get(corpus_pipeline.ROWS)) == wanted
    finally:
        spark.conf.set(corpus_pipeline.ROWS, before)


def test_language_model(docs, empty):
    rows = language_model_scores(docs).collect()
    train = [(t or "").encode().lower() for i, t in TEXTS if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    follow = [defaultdict(Counter) for _ in range(ORDER + 1)]
    words = Counter()
    for t in train:
        words.update(t.split())
        s = b"\xff" * ORDER + t + b"\xff"
        for p in range(ORDER, len(s)):
            for k in range(ORDER + 1):
                follow[k][s[p - k : p]][s[p]] += 1
    total, kinds = sum(words.values()) + len(train), len(words) + 1

    def score(t):
        s, out = b"\xff" * ORDER + t + b"\xff", 0.0
        for p in range(ORDER, len(s)):
            gone = set()
            for k in range(ORDER, -1, -1):
                seen = follow[k].get(s[p - k : p])
                if not seen:
                    continue
                left = {c: n for c, n in seen.items() if c not in gone}
                if left:
                    whole = sum(left.values()) + len(left)
                    if s[p] in left:
                        out += math.log10(left[s[p]] / whole)
                        break
                    out += math.log10(len(left) / whole)
                gone = set(seen)
            else:
                out -= math.log10(max(256 - len(gone), 1))
        return out

    wanted = Counter()
    for i, t in TEXTS:
        t = (t or "").encode().lower()
        c = [words[w] for w in t.split()] + [len(train)]
        wanted[i, len(c), sum(x > 0 for x in c), total, round(sum(math.log10((x + 1) / (total + kinds + 1)) for x in c), 4), round(score(t), 3)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4), round(r["score"], 3)) for r in rows) == wanted
    assert language_model_scores(empty).count() == 0


def test_embeddings(spark):
    g = np.random.default_rng(4)
    centres = g.standard_normal((6, 16))
    rows = []
    for k in range(300):
        v = (centres[k % 6] + g.standard_normal(16) * 0.12 * (k % 5)).astype(np.float32)
        rows.append((k, v.tolist(), k % 2))
    rows += [(300, rows[0][1], 0), (301, None, 0), (302, [0.0] * 16, 0), (303, [float("nan")] * 16, 0), (304, [None] * 16, 0), (305, rows[0][1], None), (None, rows[0][1], 0), (306, [1.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_embeddings(frame, recall=0.9999).collect()}
    usable = [(i, np.array(v, float), label) for i, v, label in rows if i is not None and (i <= 300)]
    x = np.array([v / np.linalg.norm(v) for _, v, _ in usable])
    same = np.array([label for *_, label in usable])
    near = (x @ x.T >= 0.93) & (same[:, None] == same[None])
    np.fill_diagonal(near, False)
    label = np.arange(len(usable))
    while ((new := np.minimum(label, np.where(near, label[None], 999).min(1))) != label).any():
        label = new
    for k, (i, _, _) in enumerate(usable):
        assert got[i] == (near[k].sum(), label[k], i == label[k])
    assert all(got[i] == (0, i, True) for i in (301, 302, 303, 304, 305, None, 306))
    assert near_embeddings(frame.limit(0)).count() == 0


RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"))


def test_urls(spark):
    urls = {
        1: ("http://A.Example.com/en/1?x", "a.example.com", "/en/1", "example.com/en/", "block"), 2: ("https://www.example.com/en/2", "www.example.com", "/en/2", "www.example.com/en/", "allow"),
        3: ("http://x.fr", "x.fr", "", None, "allow"), 4: ("nothing", "", "", None, "allow"), 5: (None, "", "", None, "allow"), 6: ("ftp://b.net/es/#f", "b.net", "/es/", "net/es/", "block"),
        7: ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), 8: ("", "", "", None, "allow"),
    }
    rows = [(i, u[0], "h", "v") for i, u in urls.items()] + [(k, f"http://spam{k}.example.com/en/buy", "h", "v") for k in range(100, 130)] + [(200, "http://new.example.org/en/buy", "h", "v")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(frame, RULES).collect()}
    assert {i: got[i] for i in urls} == {i: u[1:] for i, u in urls.items()}
    assert got[200] == ("new.example.org", "/en/buy", None, "block") and len(got) == len(rows)
    assert filter_urls(frame.limit(0), RULES).count() == 0


def test_halves_of_stated_rules_block_nothing(spark):
    urls = [f"http://s{k}.net/{lang}/{w}" for k in range(40) for lang in ("es", "fr") for w in ("news", "buy")] + [f"http://a.example.com/en/{k}" for k in range(60)]
    urls += [f"http://www.example.com/en/news/{k}" for k in range(40)] + [f"http://t{k}.com/de/news" for k in range(40)]
    asked = {"http://plain.net/de/": "allow", "http://plain.org/en/": "allow", "http://q.net/de/news": "allow", "http://q.org/en/news": "allow", "http://plain.org/de/buy": "block"}
    rules = (*RULES, ("block", "net", "/fr/"))
    frame = spark.createDataFrame(list(enumerate([*urls, *asked])), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in filter_urls(frame, rules).collect()}
    assert {u: got[len(urls) + k] for k, u in enumerate(asked)} == asked and len(got) == len(urls) + len(asked)


def test_url_rules_need_more_than_the_share_of_other_pages(spark):
    """A rule of three pages loses to one of 200, and one that says what most pages are anyway is none."""
    rules = [("block", "bad.com", "/"), ("allow", "good.com", "/")]
    urls = [f"http://bad.com/{'rare/' if k < 3 else ''}x{chr(97 + k % 26)}" for k in range(300)] + [f"http://good.com/news/{'abc'[k % 3]}" for k in range(200)]
    asked = {"http://else.com/rare": "allow", "http://else.com/rare/news": "allow", "http://else.com/news": "allow", "http://else.com/xa": "block", "http://else.com/other": "allow"}
    frame = spark.createDataFrame(list(enumerate([*urls, *asked])), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in filter_urls(frame, rules).collect()}
    assert {u: got[len(urls) + k] for k, u in enumerate(asked)} == asked


def test_mined_url_rules_against_counting(spark):
    """Every itemset of the labelled rows counted in plain Python gives the same rules and bounds."""
    r = random.Random(5)
    rows = [(sorted(r.sample("abcdef", r.randint(1, 4))), r.choice(["allow", "block", "block"])) for _ in range(150)]
    rows = [(items, "block" if "a" in items and r.random() < 0.95 else said) for items, said in rows]
    got = {(tuple(sorted(x["items"])), x["said"]): x["bound"] for x in mine_rules(spark.createDataFrame(rows, "items array<string>, verdict string"), 0.02, 0.7, ["f"]).collect()}
    left = [({*items} - {"f"}, said) for items, said in rows if {*items} - {"f"}]
    wanted = {}
    for width in range(1, 5):
        for items in combinations("abcde", width):
            seen = [said for have, said in left if have >= {*items}]
            for said in ("allow", "block"):
                hits, n, z2 = seen.count(said), len(seen), 1.96**2
                if not n or hits < math.ceil(0.02 * len(left)) or hits / n < 0.7:
                    continue
                p = hits / n
                bound = (p + z2 / (2 * n) - math.sqrt(z2 * (p * (1 - p) / n + z2 / (4 * n * n)))) / (1 + z2 / n)
                if n < len(left) and bound > (sum(x == said for _, x in left) - hits) / (len(left) - n):
                    wanted[items, said] = pytest.approx(bound)
    assert got == wanted and len(wanted) > 2


def test_near_copies_leave_only_their_labels(spark, docs):
    folder = Path(scratch(spark, "any").removeprefix("file:")).parent
    before = set(folder.iterdir()) if folder.exists() else set()
    kept = jaccard.keep_one(docs)
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["labelled"]
    assert 0 < kept.count() < docs.count()


def test_pipeline_stages_keep_columns(spark, docs, empty):
    for frame in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, "")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert frame.columns == docs.columns
        frame.count()


def test_pipeline_against_plain_python(spark, tmp_path):
    r = random.Random(12)
    pool = {lang: s.split() for lang, s in {"en": "the ing er on an re", "fr": "é ou eau ment que la", "fi": "kk ää yt uo jä nn"}.items()}

    def text(lang, count=70):
        return " ".join("".join(r.choice(pool[lang]) for _ in range(r.randint(1, 4))) for _ in range(count))

    passage = text("en", 30)
    texts = [(k, text(lang), lang) for k, lang in enumerate(["en", "fr"] * 30)]
    texts += [(100, passage + " " + text("en"), "en"), (101, text("en") + " " + passage, "en"), (102, texts[0][1], "en")]
    texts += [(103, " ".join([*texts[1][1].split()[:-1], "ou"]), "fr"), (104, text("en", 8), "en"), (105, "the ing " * 60, "en")]
    bad_language = [(106, text("fi"), None), (107, "| 12 | x |\n" * 40, None), (108, None, None), (109, "12 34", None)]
    spark.createDataFrame([(*x, "s", len(x[1] or "")) for x in [*texts, *bad_language]], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    left = []  # language verdicts are known by construction
    counted = Counter(quality.votes(quality.measure(t.encode())[1]) for _, t, _ in texts)
    posterior = quality.label_model(counted)
    for i, t, _ in texts:
        n, *_, repeated = brute_measures(t)
        if n >= 20 and 100 * repeated <= 30 * n and posterior[quality.votes(quality.measure(t.encode())[1])] >= 0.5:
            left.append((i, t))
    assert {i for i, _ in left} == {i for i, *_ in texts} - {104, 105}
    left = [(i, t) for i, t in left if (i, len(shingle_set(t, 5)), i) in brute_components(left, 5, 80)]
    assert {102, 103}.isdisjoint(i for i, _ in left)
    first, wanted = {}, {}
    for i, t in sorted(left):
        w = t.split()
        keep = [True] * len(w)
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k : k + 13]), i) < i:
                keep[k : k + 13] = [False] * 13
        wanted[i] = [*ids_of(t if all(keep) else " ".join(x for x, y in zip(w, keep, strict=True) if y)), 2]
    assert len(wanted[101]) < len(ids_of(texts[61][1]))
    pieces = defaultdict(list)
    for row in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces[row["doc_id"]].append((row["start"], row["ids"]))
    assert {i: [x for _, ids in sorted(parts) for x in ids] for i, parts in pieces.items()} == wanted
