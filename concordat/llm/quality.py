"""Quality by weak supervision: rules vote good or bad or abstain, and a label model weighs their votes.

Every text is measured and votes. Equal vote patterns are counted, of which there are at most three to the number of
rules, and expectation-maximisation estimates each rule's rates from the counts alone. A document is kept by its posterior
probability of being good, instead of having to pass every rule: several rules look at each sort of junk, so that junk is
called bad by more than one, and a rule that stands alone against all others is outvoted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.shared import stored

SYMBOLS = b"#*$%&|<>"
_SYMBOL_WORD = re.compile(rb"[#*$%&|<>]\S*")
_NO_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
REPEAT_WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: (name, measure, bad from, good up to); between the two bounds a rule abstains. Bounds that fall turn the rule round.
RULES = (
    ("words", "n_words", 20, 40),
    ("symbols", "symbols per word", 0.2, 0.1),
    ("symbol words", "share of words with a symbol", 0.2, 0.1),
    ("letters", "letter share of bytes", 0.7, 0.85),
    ("duplicate lines", "duplicate share of lines", 0.5, 0.2),
    ("repeats", "repeated share of words", 0.3, 0.1),
    ("word length short", "characters per word", 2.5, 3.5),
    ("word length long", "characters per word", 12.0, 9.0),
    ("upper case", "upper-case share of bytes", 0.4, 0.15),
    ("digits", "digit share of bytes", 0.2, 0.08),
    ("echoes", "share of words like the one before", 0.3, 0.1),
    ("echoes of two", "share of words like the second before", 0.3, 0.1),
)
#: (weight as a share of the corpus, mean) of the beliefs about a rule's rate of bad votes among bad and among good texts,
#: and about the share of bad texts.
BELIEF = ((0.05, 0.1), (1.0, 0.02), (0.1, 0.1))


def repeated_words(words: np.ndarray, width: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of so many words which the text holds twice or more. words: a 64-bit hash of each."""
    count = len(words) - width + 1
    if count < 2:
        return 0
    code, span = words, 1
    while span < width:  # doubles the span; width is a power of two
        code = code[: len(code) - span] * np.uint64(0x9E3779B97F4A7C15) + (code[span:] ^ (code[span:] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        span *= 2
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    starts = np.zeros(len(words) + 1, np.int32)
    twice = np.zeros(count, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    places = np.flatnonzero(twice)
    np.add.at(starts, places, 1)
    np.add.at(starts, places + width, -1)
    return int((np.cumsum(starts)[:-1] > 0).sum())


def measure(text: bytes) -> tuple[list[int], dict[str, float]]:
    """The counts of MEASURES, and the ratios that rules look at."""
    words = text.split()
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    raw = np.frombuffer(text, np.uint8)
    points = len(raw) - int(np.count_nonzero((raw & 0xC0) == 0x80))
    blanks = len(text) - sum(map(len, words))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    doubled = len(lines) - len(set(lines))
    repeats = repeated_words(hashes)
    n, size = max(len(words), 1), max(len(text) - blanks, 1)
    marked = len(_SYMBOL_WORD.findall(text)) if symbols else 0
    counts = [len(words), points - blanks, symbols, doubled, repeats]
    return counts, {
        "n_words": len(words), "symbols per word": symbols / n, "share of words with a symbol": marked / n,
        "letter share of bytes": len(text.translate(None, _NO_LETTERS)) / size, "duplicate share of lines": doubled / max(len(lines), 1),
        "repeated share of words": repeats / n, "characters per word": counts[1] / n,
        "upper-case share of bytes": (len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / size,
        "share of words like the one before": np.count_nonzero(hashes[1:] == hashes[:-1]) / n,
        "share of words like the second before": np.count_nonzero(hashes[2:] == hashes[:-2]) / n,
        "digit share of bytes": (len(text) - len(text.translate(None, b"0123456789"))) / size,
    }


def votes(ratios: dict[str, float]) -> int:
    """The votes as a number to base 3, the first rule last: 0 abstains, 1 is bad, 2 is good."""
    pattern = 0
    for _, name, bad, good in reversed(RULES):
        x = ratios[name]
        vote = (1 if x < bad else 2 if x >= good else 0) if good > bad else (1 if x > bad else 2 if x <= good else 0)
        pattern = pattern * 3 + vote
    return pattern


def label_model(counts: dict[int, int], rounds: int = 500) -> dict[int, float]:
    """Posterior probability of good for each vote pattern, by expectation-maximisation over the pattern counts.

    Two classes; each rule has a rate of bad votes among the votes that it casts in a class, and abstaining says nothing.
    Nothing bounds the rates. They start from a belief whose weight is a share of the corpus, so that the model is the same
    at any size: BELIEF. Where the votes of bad texts go together, the rates follow them; a rule that mostly stands alone
    keeps a low rate among bad texts, and its lone votes do not make a text bad.
    """
    if not counts:
        return {}
    patterns = np.array(sorted(counts))
    weight = np.array([counts[p] for p in patterns], float)
    weight /= weight.sum()
    table = patterns[:, None] // 3 ** np.arange(len(RULES)) % 3
    bad, good = (table == 1).astype(float), (table == 2).astype(float)
    strength, mean = np.array(BELIEF)[:2, :1], np.array(BELIEF)[:2, 1:]
    base_strength, bad_share = BELIEF[2]
    post = np.where(bad.any(1), 0.05, 0.95)
    for _ in range(rounds):
        shares = np.stack([weight * (1 - post), weight * post])
        rate = (shares @ bad + strength * mean) / (shares @ (bad + good) + strength)
        base = (shares.sum(1) + base_strength * np.array([bad_share, 1 - bad_share])) / (1 + base_strength)
        score = np.log(base) + bad @ np.log(rate).T + good @ np.log1p(-rate).T
        new = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -500, 500)))
        moved, post = np.abs(new - post).max(), new
        if moved < 1e-9:
            break
    return dict(zip(patterns.tolist(), post.tolist(), strict=True))


def measured(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The kept columns as kept_0 and so on, the counts of MEASURES and the vote pattern of every row. A null text has no words."""
    work = docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.col(text_col).cast("binary").alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(batch.num_columns - 1):
                counts, ratios = measure(text.as_py() or b"")
                rows.append([*counts, votes(ratios)])
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            found = np.array(rows, np.int64).reshape(-1, len(MEASURES) + 1)
            columns += [pa.array(found[:, i]) for i in range(found.shape[1])]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], *MEASURES, "pattern"])

    kinds = [f"kept_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    return work.mapInArrow(run, ", ".join([*kinds, *(f"{m} bigint" for m in MEASURES), "pattern bigint"]))


def _posterior(found: DataFrame) -> dict[int, float]:
    return label_model({r[0]: r[1] for r in found.groupBy("pattern").count().collect()})  # 3 ** rules rows at most


def quality_rules(docs: DataFrame, min_quality: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the five counts, base_failed, kept and quality.

    A null text counts as empty and fails; a null id stays null; repeated rows are judged each, and each counts in the
    estimate; an empty table gives no rows. Texts are read once: the second pass reads the stored counts.
    """
    found = stored(measured(docs, [id_col], text_col), "quality").withColumnRenamed("kept_0", "doc_id")
    posterior = docs.sparkSession.createDataFrame(list(_posterior(found).items()), "pattern bigint, quality double")
    judged = found.join(F.broadcast(posterior), "pattern")  # 3 ** rules rows at most
    judged = judged.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= min_quality))
    return judged.select("doc_id", *MEASURES, "base_failed", "kept", "quality")


def keep_good(docs: DataFrame, min_quality: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns; of equal names too, since columns are carried by place.

    Texts are measured twice, for the estimate and for the verdict: that costs less than storing all texts with their
    votes in between.
    """
    names = docs.columns
    at = names.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    posterior = _posterior(measured(plain, [], f"c{at}").select("pattern"))
    good = docs.sparkSession.sparkContext.broadcast({p for p, q in posterior.items() if q >= min_quality})

    def fits(text: bytes) -> bool:
        counts, ratios = measure(text)
        failed = counts[0] < 20 or 100 * counts[MEASURES.index("n_repeat_words")] > 30 * counts[0]
        return not failed and votes(ratios) in good.value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([fits(t.as_py() or b"") for t in batch.column(at).cast(pa.binary())], pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*names)
