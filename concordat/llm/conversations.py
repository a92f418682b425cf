"""Conversation structure repair: least-cost edits to a grammar of roles, decided once for all conversations.

A row is reduced to a signature of one byte: the initial of its role and its fault. A conversation is the string of its
signatures. Strings are read from the end in a suffix-shared automaton: in the sorted order of reversed strings, those that
end alike are neighbours, so a task keeps the nodes of one path and adds a node only where a string leaves its
predecessor. A node holds, for each state of the grammar, the cost to go and the first letter of the best audit; the rest of
the audit is that of the node that the letter leads to. Nodes whose costs differ by a constant decide alike whatever comes
before them, which makes classes of nodes few, and the work of a node one look-up.

Rows are dealt out by range of (conversation, turn), so one huge conversation is spread over tasks; it is reduced to pieces
of bounded size. Its audit takes a byte an edit, and only its digest, which is sequential, reads its pieces in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.shared import groups, stored

#: A character that is not white space, and one that ends a sentence; both as the rules state them.
VISIBLE, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of `(s?(ua)+)?`: nothing yet, after s, after u, after a. What may follow by a kept row, and what an insertion adds.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FILL = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
ROWS, BYTES = 4096, 4 << 20


def signature(initial: str, doomed: bool, truncated: bool) -> str:
    """x for a row that has to go, else its role's initial (o for others), in upper case if it is truncated."""
    letter = "x" if doomed else initial if initial in ("s", "u", "a") else "o"
    return letter.upper() if truncated and not doomed else letter


class Automaton:
    """Classes of nodes: costs to go by state, less the least of them; a step leads from a class by a signature.

    A step gives (class, least cost, letters, states): for each state the first letter of the best audit and the state after
    it. Letter I stays at its node.
    """

    def __init__(self):
        self._class: dict[tuple[int, ...], int] = {}
        self._costs: list[tuple[int, ...]] = []
        self._steps: dict[tuple[int, str], tuple] = {}
        self.end = self._close([(0, "", START), None, None, (0, "", ASSISTANT)])

    def _close(self, own: list[tuple[int, str, int] | None]) -> tuple:
        """The node of which own tells, for each state, what the edits of its row cost at best; insertions are added."""

        def least(state: int, insertions: int = 3) -> int:  # no state needs more
            after = [INSERT + least(FILL[state], insertions - 1)] if insertions else []
            return min([*after, *([own[state][0]] if own[state] else [])], default=1 << 30)

        costs = tuple(least(state) for state in range(4))
        # By cost, then by letter. Every letter leads to one state, so the first audit begins with the first letter.
        chosen = [min(o for o in (own[s], (INSERT + costs[FILL[s]], "I", FILL[s])) if o) for s in range(4)]
        low = min(costs)
        shape = tuple(c - low for c in costs)
        number = self._class.setdefault(shape, len(self._costs))
        if number == len(self._costs):
            self._costs.append(shape)
        return number, low, [c[1] for c in chosen], [c[2] for c in chosen]

    def cost(self, node: tuple, state: int) -> int:
        return self._costs[node[0]][state]

    def step(self, node: tuple, sign: str) -> tuple:
        """The node before this one, for a row of that signature."""
        known = self._steps.get((node[0], sign))
        if known is None:
            behind = self._costs[node[0]]
            known = self._steps[node[0], sign] = self._close([self._own(behind, sign, state) for state in range(4)])
        return known

    @staticmethod
    def _own(behind: tuple[int, ...], sign: str, state: int) -> tuple[int, str, int]:
        options = [(DELETE + behind[state], "D", state)]
        if sign != "x":
            extra = TRUNCATED if sign.isupper() else 0
            kept = NEXT.get(sign.lower(), {}).get(state)
            if kept is not None:
                options.append((KEEP + extra + behind[kept], "K", kept))
            options.append((REROLE + extra + behind[FILL[state]], "R", FILL[state]))
        return min(options)


def best_edits(strings: Iterator[str], automaton: Automaton) -> Iterator[tuple[str, int, str]]:
    """(string, cost, audit) of signature strings that come in the order of their reversals."""
    path: list[tuple] = [automaton.end]
    sums = [automaton.end[1]]
    last = ""
    for string in strings:
        backward = string[::-1]
        shared = 0
        for a, b in zip(last, backward, strict=False):
            if a != b:
                break
            shared += 1
        del path[shared + 1 :], sums[shared + 1 :]
        for sign in backward[shared:]:
            path.append(automaton.step(path[-1], sign))
            sums.append(sums[-1] + path[-1][1])
        last = backward
        audit, state, depth = [], START, len(string)
        while True:
            letter = path[depth][2][state]
            if not letter:
                break
            audit.append(letter)
            state = path[depth][3][state]
            depth -= letter != "I"
        yield string, sums[-1] + automaton.cost(path[-1], START), "".join(audit)


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, copies of the rows that are left when each has been damaged by its own hash.

    By crc32 of `conv:turn` modulo 20: 0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and question
    marks, 3 repeats it, 4 calls its role user. A null counts as one space, in the hash as in role and text.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    rows = rows.select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    body = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.where("kind <> 0").select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), body.alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("bigint").alias("copies"))


PIECE = (
    "conv bigint, part int, piece int, signs string, roles array<string>, texts array<string>, copies array<bigint>, first string, last string, "
    "illegal bigint, blank bigint, duplicate bigint, truncated bigint, turns bigint, low bigint, high bigint"
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of one conversation, in order, as pieces of at most ROWS rows and about BYTES bytes of text."""
    names = [c.split()[0] for c in PIECE.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.string(), pa.string(), *[pa.int64()] * 7]
    out: list[list] = []
    size = number = 0
    now: dict | None = None

    def close() -> None:
        turns = [t for t in now["seen"] if t is not None]
        faults = now["faults"]
        out.append([now["conv"], now["part"], now["number"], "".join(now["signs"]), now["roles"], now["texts"], now["copies"], now["first"], now["last"],
                    now["illegal"], faults[1], faults[2], faults[3], len(turns), min(turns, default=None), max(turns, default=None)])

    def flush() -> pa.RecordBatch:
        done = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names)
        out.clear()
        return done

    for batch in batches:
        for conv, part, turn, role, text, copies, fault in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if now is None or conv != now["conv"] or len(now["signs"]) >= ROWS or now["bytes"] > BYTES:
                if now is not None:
                    size += now["bytes"]
                    close()
                    if size > BYTES:
                        yield flush()
                        size = 0
                number = number + 1 if now is not None else 0
                now = {"conv": conv, "part": part, "number": number, "signs": [], "roles": [], "texts": [], "copies": [], "first": role[:1], "last": None,
                       "illegal": 0, "faults": [0] * 4, "seen": set(), "bytes": 0}
            initial = role[:1]
            if now["last"] is not None:
                now["illegal"] += now["last"] + initial not in ("su", "ua", "au")
            now["illegal"] += copies - 1  # a role does not follow itself
            now["last"] = initial
            # Copies of a row repeat it, unless it is blank, which is its first fault.
            now["faults"][fault] += 1
            now["faults"][fault if fault == 1 else 2] += copies - 1
            now["signs"].append(signature(initial, fault in (1, 2), fault == 3) + "x" * (copies - 1))
            now["roles"].append(role)
            now["texts"].append(text)
            now["copies"].append(copies)
            now["seen"].add(turn)
            now["bytes"] += len(text) + len(role) + copies
    if now is not None:
        close()
        yield flush()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, digest) of conversations: a row with the audit, then the pieces in order."""
    out: list[tuple[int | None, str]] = []
    now = None

    def flush() -> pa.RecordBatch:
        done = pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string())], ["conv", "repaired_sha256"])
        out.clear()
        return done

    for batch in batches:
        for conv, audit, roles, texts, copies in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if audit is not None:
                if now is not None:
                    out.append((now.conv, now.finish()))
                now = _Repair(conv, audit)
                continue
            for role, text, times in zip(roles, texts, copies, strict=True):
                for _ in range(times):
                    now.row(role, text)
        if len(out) > ROWS:
            yield flush()
    if now is not None:
        out.append((now.conv, now.finish()))
    yield flush()


class _Repair:
    """Carries out an audit row by row and keeps the digest of the lines that it leaves."""

    def __init__(self, conv: int | None, audit: str):
        self.conv, self._audit, self._at, self._state = conv, audit, 0, START
        self._digest, self._gap = hashlib.sha256(), ""

    def _line(self, role: str, text: str) -> None:
        self._digest.update((self._gap + role + ":" + text).encode())
        self._gap = "\n"

    def _insert(self) -> None:
        while self._audit[self._at : self._at + 1] == "I":
            self._state = FILL[self._state]
            self._line(ROLE_OF[self._state], "")
            self._at += 1

    def row(self, role: str, text: str) -> None:
        self._insert()
        letter = self._audit[self._at]
        self._at += 1
        if letter == "K":
            self._state = NEXT[role[:1]][self._state]
            self._line(role, text)
        elif letter == "R":
            self._state = FILL[self._state]
            self._line(ROLE_OF[self._state], text)

    def finish(self) -> str:
        self._insert()
        return self._digest.hexdigest()


def repair_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", damage: bool = True,
) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    With damage, rows are damaged first (see damaged), and conversations of which nothing is left are returned with zeros,
    an empty audit and the digest of nothing. Rows come by turn, nulls first, and those of one turn by role and text. A null
    role or text is one space. The first fault of a row counts: blank, duplicate (its role and text came before in its
    conversation), truncated (its last visible character ends no sentence). gaps are whole turns missing between the least
    and the greatest; illegal counts neighbours whose initials are not su, ua or au.

    The edits with the least cost whose kept, changed and added rows read `(s?(ua)+)?` are returned by their initials, the
    first in ASCII order of those that cost the same. The digest is that of the repaired `role:text` lines. Rows with a null
    conv_id are one conversation. An empty table gives no rows; rows that repeat each other are duplicates.
    """
    whole = rows.select(F.col(conv_col).cast("bigint").alias("conv")).distinct()
    work = damaged(rows, conv_col, turn_col, role_col, text_col) if damage else rows.select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), F.coalesce(role_col, F.lit(" ")).alias("role"),
        F.coalesce(text_col, F.lit(" ")).alias("text"), F.lit(1).cast("bigint").alias("copies"))
    work = work.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    work = stored(work.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary")))), "conversation-rows")
    # The first turn of every text of a role: less in each map task already, so a common text is no hot key.
    seen = work.groupBy("conv", "role", "digest").agg(F.max(F.col("turn").isNull()).alias("unplaced"), F.min("turn").alias("first_turn"), F.count("*").alias("times"))
    seen = seen.where("times > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "unplaced", "first_turn")
    same: Column = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    later = F.coalesce(F.col("turn").isNotNull() & (F.col("unplaced") | (F.col("turn") > F.col("first_turn"))), F.lit(False))
    fault = F.when(~F.col("text").rlike(VISIBLE), 1).when(later, 2).when(~F.col("text").rlike(ENDED), 3).otherwise(0)
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    flagged = work.join(seen, same, "left").select("conv", "turn", "role", "text", "copies", fault.alias("fault"))
    flagged = stored(flagged, "conversation-faults")
    dealt = flagged.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", F.spark_partition_id().alias("part"), "turn", "role", "text", "copies", "fault")
    pieces = stored(dealt.mapInArrow(_pieces, PIECE), "conversation-pieces")

    # Pieces of a conversation follow each other; a turn that two share counts once.
    seam = F.arrays_zip(F.slice("p", 1, F.size("p") - 1).alias("x"), F.slice("p", 2, F.size("p")).alias("y"))
    facts = pieces.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("part", "piece", "signs", "first", "last", "low", "high"))).alias("p"),
        *[F.sum(c).alias(c) for c in ("illegal", "blank", "duplicate", "truncated", "turns")], F.min("low").alias("low"), F.max("high").alias("high"))
    facts = facts.withColumn("seam", seam)
    facts = facts.select(
        "conv", F.concat_ws("", F.transform("p", lambda x: x["signs"])).alias("signs"), "blank", "duplicate", "truncated",
        (F.col("illegal") + F.size(F.filter("seam", lambda s: ~F.concat(s["x"]["last"], s["y"]["first"]).isin("su", "ua", "au")))).alias("illegal"),
        F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns") + F.size(F.filter("seam", lambda s: s["x"]["high"] == s["y"]["low"])), F.lit(0)).alias("gaps"))
    facts = stored(facts, "conversation-facts")
    strings = facts.select("signs", F.reverse("signs").alias("backward")).distinct()
    strings = strings.repartitionByRange("backward").sortWithinPartitions("backward").select("signs")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        waiting: list[tuple[str, int, str]] = []
        size = 0

        def each() -> Iterator[str]:
            for batch in batches:
                yield from batch.column(0).to_pylist()

        for found in best_edits(each(), automaton):
            waiting.append(found)
            size += len(found[0]) + len(found[2])
            if size > BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*waiting, strict=True)], ["known", "cost", "audit"])
                waiting, size = [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*waiting, strict=True)], ["known", "cost", "audit"])

    audits = strings.mapInArrow(decide, "known string, cost bigint, audit string")
    decided = stored(facts.join(audits, F.col("signs") == F.col("known")).drop("known", "signs"), "conversation-audits")
    body = pieces.select("conv", "part", "piece", F.lit(None).cast("string").alias("audit"), "roles", "texts", "copies")
    heads = decided.select("conv", "audit", F.lit(-1).alias("part"), F.lit(-1).alias("piece"))
    lines = body.unionByName(heads, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "part", "piece").select("conv", "audit", "roles", "texts", "copies")
    digests = lines.mapInArrow(_repaired, "conv bigint, repaired_sha256 string").withColumnRenamed("conv", "d")
    done = decided.join(digests, F.col("conv").eqNullSafe(F.col("d"))).drop("d").withColumnRenamed("conv", "c")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return whole.join(done, F.col("conv").eqNullSafe(F.col("c")), "left").select(
        F.col("conv").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
