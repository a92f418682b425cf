"""Hard negatives, exact top-k and conversation repair on small tables, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordat.llm import conversations, hard_negatives, vectors
from concordat.llm.conversations import Automaton, best_edits, repair_conversations
from concordat.llm.top_k import SortedLists, exact_top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, key string, q string, tile string, positives string"


def embeddings(count, seed, dims=6):
    """Clustered vectors, with ties, a vector that many share, nulls, short ones and ids that repeat."""
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(3)]
    out = [(i, [r.choice(centres)[d] + r.gauss(0, 0.2) for d in range(dims)], i % 3) for i in range(count)]
    out += [(1000 + i, [0.5] * dims, i % 2) for i in range(count // 3)]
    out += [(2000, None, 1), (2001, [1.0, None], 1), (2002, [math.nan] * dims, 1), (2003, [math.inf] * dims, 0), (2004, [0.0] * dims, 2), (2005, [], 0)]
    out += [(2006, [1.0], None), (None, [1.0] * dims, 1), (2100, [0.3] * dims, 1), (2100, [0.3] * dims, 1), (2100, [-0.3] * dims, 2), (2007, [-0.7] * (dims - 2), 1)]
    return out


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * float(np.float32(x))) for x in v]


def product(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, *"abcdef") for i, v, label in rows], SCHEMA).repartition(3)


def asking(rows, modulus):
    return sorted({(i, tuple(w), label) for i, v, label in rows if i is not None and i % modulus == 0 and (w := whole(v)) is not None}, key=repr)


def brute_top(rows, modulus, k):
    out = Counter()
    for i, q in sorted({a[:2] for a in asking(rows, modulus)}):
        ranked = sorted((-product(q, w), j) for j, v, _ in rows if j is not None and j != i and (w := whole(v)) is not None)
        out.update((i, rank, j, -s) for rank, (s, j) in enumerate(ranked[:k], 1))
    return out


def brute_negatives(rows, modulus, positives, negatives, lower):
    out = Counter()
    for i, q, label in asking(rows, modulus):
        if label is None:
            continue
        ranked = sorted((-product(q, w), j, other) for j, v, other in rows if j is not None and j != i and other is not None and (w := whole(v)) is not None)
        for s, p, _ in [x for x in ranked if x[2] == label][:positives]:
            fit = [(t, j) for t, j, other in ranked if other != label and lower * -s <= 100 * -t <= 100 * -s]
            out.update((i, p, rank, j, -s, -t) for rank, (t, j) in enumerate(fit[:negatives], 1))
    return out


@pytest.fixture(params=[(vectors.COMPONENTS, 1024), (64, 4)], ids=["one block", "many blocks"])
def block_size(request, monkeypatch):
    monkeypatch.setattr(vectors, "COMPONENTS", request.param[0])
    monkeypatch.setattr(vectors, "FEWEST", request.param[1])


def test_top_k_equals_brute_force(spark, block_size):
    rows = embeddings(60, 1)
    got = Counter(tuple(r) for r in exact_top_k(frame(spark, rows), F.col("vec_id") % 5 == 0, k=4).collect())
    assert got == brute_top(rows, 5, 4)
    assert len(got) > 50


def test_hard_negatives_equal_brute_force(spark, block_size):
    rows = embeddings(70, 2)
    found = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 7 == 0, F.col("label"), positives=4, negatives=3, lower=50)
    assert Counter(tuple(r) for r in found.collect()) == brute_negatives(rows, 7, 4, 3, 50)
    assert found.count() > 50


@pytest.mark.parametrize("scale", [3e4, 4e5, 1e18])
def test_scores_are_exact_for_any_size_of_component(spark, scale):
    rows = [(i, [float(np.float32(scale * ((i * 37 + d * 11) % 19 - 9))) for d in range(3)], i % 2) for i in range(40)]
    got = exact_top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, k=3).collect()
    held = Counter((i, r, j, min(max(s, -(1 << 63)), (1 << 63) - 1)) for i, r, j, s in brute_top(rows, 10, 3))
    if scale < 1e9:
        assert Counter(tuple(r) for r in got) == held
    else:  # beyond 64 bits scores are held at the end, where ties go to smaller ids
        assert {r["score"] for r in got} == {(1 << 63) - 1}


def test_threshold_search_stops_early():
    r = np.random.default_rng(5)
    x = np.floor(256 * r.exponential(0.2, (4000, 4)))
    lists = SortedLists(vectors.Block(np.arange(4000), np.zeros(4000), x))
    q = np.array([250.0, 1.0, 0.0, 3.0])
    best, scores, met = lists.search(q, -1, 5)
    assert best.tolist() == vectors.first_of((x @ q).astype(np.int64), np.arange(4000), 5).tolist()
    assert met < 2000


def test_slots():
    assert hard_negatives.window(7, 80, 100) == (6, 7)
    assert hard_negatives.slot_limits([9, 9, 4, -3], 80, 100) == ([9, 4], 4)
    assert hard_negatives.merge_slots([[(1, 9)], [], [(2, 3), (3, 1)]], 2) == [[(1, 9), (2, 3)], [(2, 3), (3, 1)], [(2, 3), (3, 1)]]


def test_no_rows_no_queries(spark):
    empty = spark.createDataFrame([], SCHEMA)
    some = frame(spark, embeddings(9, 3))
    assert exact_top_k(empty, F.col("vec_id") % 5 == 0).count() == 0
    assert exact_top_k(some, F.lit(False)).count() == 0
    assert hard_negatives.hard_negatives(empty, F.lit(True), F.col("label")).count() == 0
    assert hard_negatives.hard_negatives(some, F.lit(False), F.col("label")).count() == 0


ROLES = {0: "u", 1: "u", 2: "a", 3: "u"}
AFTER = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
NAME = {"u": "user", "a": "assistant"}


def brute_edits(rows):
    """(cost, audit, lines) of rows (role, text, fault) by trying every edit, with up to three insertions in a row."""

    @lru_cache(None)
    def best(i, state, added):
        options = [(0, "", ())] if i == len(rows) and state in (0, 3) else []

        def more(cost, letter, j, to, inserts, line=None):
            c, a, lines = best(j, to, inserts)
            options.append((c + cost, letter + a, ((line,) if line is not None else ()) + lines))

        if added < 3:
            i_role = ROLES[state]
            more(3, "I", i, AFTER[i_role, state], added + 1, NAME[i_role] + ":")
        if i < len(rows):
            role, text, fault = rows[i]
            more(4, "D", i + 1, state, 0)
            if fault not in (1, 2):
                extra = 3 if fault == 3 else 0
                if (role[:1], state) in AFTER:
                    more(extra, "K", i + 1, AFTER[role[:1], state], 0, f"{role}:{text}")
                to = ROLES[state]
                more(3 + extra, "R", i + 1, AFTER[to, state], 0, f"{NAME[to]}:{text}")
        return min(options, default=(10**9, "", ()))

    for i in range(len(rows), 0, -1):  # from the end, so that calls do not nest
        for state in range(4):
            best(i, state, 0)
    return best(0, 0, 0)


def brute_repair(table):
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        kept = groups[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
        kept += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = Counter()
    for conv, rows in groups.items():
        rows.sort()
        seen, judged = set(), []
        for _, _, role, text in rows:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = {t for known, t, _, _ in rows if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults = Counter(f for _, _, f in judged)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:], strict=False))
        cost, audit, lines = brute_edits(tuple(judged))
        out[conv, gaps, faults[1], faults[2], faults[3], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()] += 1
    return out


def conversation_rows(seed, count):
    r = random.Random(seed)
    texts = ["Yes.", "No?", "go on", "", " \t\n", "Wait! \n", "été.", None, "a ", "\x0b."]
    out = []
    for conv in range(count):
        turn = r.randint(-2, 3)
        for at in range(r.randint(1, 9)):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "Ursula", "sam"]) if r.random() < 0.3 else ["user", "assistant"][at % 2]
            text = r.choice(texts) if r.random() < 0.4 else f"Line {conv % 5} {at}."
            out.append((conv, None if r.random() < 0.05 else turn, role, text))
            turn += r.choice([0, 1, 1, 1, 1, 4])
    out += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, None, "system", "Be kind.")]
    return out + out[:7]  # some rows repeat


CONVERSATIONS = "conv_id long, turn long, role string, text string, cost string, audit string, conv string, part string, signs string"


def conversation_frame(spark, rows):
    return spark.createDataFrame([(*row, *"abcde") for row in rows], CONVERSATIONS).repartition(3)


def test_repair_equals_brute_force(spark):
    rows = conversation_rows(1, 150)
    got = Counter(tuple(r) for r in repair_conversations(conversation_frame(spark, rows)).collect())
    assert got == brute_repair(rows)
    assert len({r[7] for r in got}) > 60


def test_long_conversations_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversations, "ROWS", 16)
    r = random.Random(4)
    rows = [(7, t // 2, r.choice(["user", "assistant", "system"]), r.choice(["Yes.", "no", f"Turn {t}.", ""])) for t in range(400)] + conversation_rows(2, 20)
    rows += [(8, 1, "user", "Again and again.")] * 50 + [(9, None, "user", "Never."), (9, None, "assistant", "Ever.")]
    got = Counter(tuple(r) for r in repair_conversations(conversation_frame(spark, rows).repartition(7)).collect())
    assert got == brute_repair(rows)


def test_conversations_of_which_nothing_is_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = repair_conversations(conversation_frame(spark, [(gone, 0, "user", "Hello.")])).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert repair_conversations(spark.createDataFrame([], CONVERSATIONS)).count() == 0


def test_automaton_shares_suffixes():
    """Every distinct suffix is one step, and the classes of nodes stay few."""
    r = random.Random(8)
    strings = sorted({"".join(r.choice("suaoxSUAO") for _ in range(r.randint(0, 12))) for _ in range(3000)}, key=lambda s: s[::-1])
    steps = []

    class Counting(Automaton):
        def step(self, node, sign):
            steps.append(sign)
            return super().step(node, sign)

    automaton = Counting()
    assert len(list(best_edits(iter(strings), automaton))) == len(strings)
    assert len(steps) == len({s[i:] for s in strings for i in range(len(s))})
    assert len(automaton._costs) < 100
