"""Language identification by a string kernel.

Two texts are as alike as the n-grams that both hold, of 1 to 4 bytes of lower-case text, present or not: a
blended-spectrum presence kernel, divided by the norms. Nyström landmarks span the feature space and one ridge
regression per language is fitted in it. As the kernel is linear in the presence vector, a batch of documents is
scored by one product of its presence matrix with the folded weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.chunks import library_encoder
from concordat.llm.shared import held_out

ORDERS = (1, 2, 3, 4)
#: N-grams are told apart by this many bits of a hash.
HASH_BITS = 20
#: Documents in one product: a row of it has a column for each n-gram of the landmarks.
BATCH = 16
#: A text is in a known language if the winner's score is this far above the second's; labelled scores lie at 1 and -1.
#: Set on 3,500 labelled documents of sf0.1, not held out and not learned from: 11 of them fall below, which are single
#: words, shouted lines and texts in two languages. Eight other languages (0.01 to 0.24), markup, tables and hex fall below too;
#: of noise made of random letters, 1 % at 80 words and up to 15 % at 16 words or fewer do not.
MIN_MARGIN = 0.25


def gram_codes(text: bytes) -> np.ndarray:
    """A code below 2**HASH_BITS for every n-gram at every place of the text, repeats included."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    out = []
    code = np.zeros(len(raw), np.uint64)
    for n in ORDERS:
        if len(raw) < n:
            break
        code = (code[: len(raw) - n + 1] << np.uint64(8)) | raw[n - 1 :]
        mixed = (code + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((mixed >> np.uint64(64 - HASH_BITS)).astype(np.uint32))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


class Presence:
    """Rows of 0 and 1 over the n-grams of the landmarks."""

    def __init__(self, grams: np.ndarray):
        self.place = np.full(1 << HASH_BITS, -1, np.int32)
        self.place[grams] = np.arange(len(grams), dtype=np.int32)
        self.width = len(grams)

    def rows(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), self.width + 1), np.float32)
        for row, text in zip(out, texts, strict=True):
            row[self.place[gram_codes(text)]] = 1  # what no landmark holds goes to the last column
        return out[:, :-1]


def fit(texts: list[bytes], langs: list[str], landmarks: int, ridge: float) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(n-grams, languages, weights): scores are presence rows times weights, divided by the rows' norms."""
    names = sorted(set(langs))
    step = max(1, len(texts) // landmarks)
    spread = texts[::step][:landmarks]
    grams = np.unique(np.concatenate([gram_codes(t) for t in spread] or [np.empty(0, np.uint32)]))
    presence = Presence(grams)

    def unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))

    anchors = unit(presence.rows(spread)).astype(np.float64)
    values, vectors = np.linalg.eigh(anchors @ anchors.T)
    keep = values > 1e-6 * values.max(initial=1e-12)
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    features = np.concatenate([unit(presence.rows(texts[i : i + 256])).astype(np.float64) @ anchors.T for i in range(0, len(texts), 256)]) @ whiten
    target = np.array([[1.0 if lang == n else -1.0 for n in names] for lang in langs])
    weights = np.linalg.solve(features.T @ features + ridge * np.eye(features.shape[1]), features.T @ target)
    return grams, names, (anchors.T @ whiten @ weights).astype(np.float32)


def training_sample(
    docs: DataFrame, per_language: int, sample_rows: int, modulus: int, remainder: int, id_col: str, text_col: str, lang_col: str,
) -> list[tuple[str, bytes]]:
    """(language, lower-case text) of labelled documents, chosen and ordered by hashes of the id and the text.

    At most per_language of each language, and sample_rows in all, dealt to the languages in turn. Held-out ids are left
    out. Both limits are applied in the map tasks, on ids alone, before anything is shuffled or sent.
    """
    order = F.xxhash64(F.col(id_col)), F.col(id_col), F.col("__mark")
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & F.col(id_col).isNotNull() & ~held_out(id_col, modulus, remainder))
    # Of rows that repeat an id, the text's hash tells which come first; equal rows are one.
    usable = usable.withColumn("__mark", F.xxhash64(text_col))
    place = F.row_number().over(Window.partitionBy(lang_col).orderBy(*order))
    ids = usable.select(id_col, lang_col, "__mark").withColumn("place", place).where(F.col("place") <= per_language).orderBy("place", *order).limit(sample_rows)
    chosen = ids.select(id_col, "__mark").collect()
    if not chosen:
        return []
    found = usable.where(F.col(id_col).isin([r[0] for r in chosen]) & F.col("__mark").isin([r[1] for r in chosen])).groupBy(id_col, "__mark", lang_col).agg(F.any_value(text_col).alias("__text"))
    rows = found.select(lang_col, F.lower("__text").cast("binary"), F.crc32(F.col(id_col).cast("string").cast("binary"))).collect()
    return [(r[0], bytes(r[1])) for r in sorted(rows, key=lambda r: (r[2], r[0], bytes(r[1])))]


def _predict(
    docs: DataFrame, per_language: int = 250, sample_rows: int = 2000, landmarks: int = 240, ridge: float = 1.0, modulus: int = 4, remainder: int = 2,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None,
) -> DataFrame:
    """predict_languages, and margin: how far the winner's score is above the second's, or above 0 if one language is known.

    Null where nothing was scored.
    """
    rows = training_sample(docs, per_language, sample_rows, modulus, remainder, id_col, text_col, lang_col)
    grams, names, weights = fit([r[1] for r in rows], [r[0] for r in rows], landmarks, ridge) if rows else (np.empty(0, np.uint32), [], None)
    model = docs.sparkSession.sparkContext.broadcast((grams, names, weights))
    keep = [id_col] if keep is None else keep

    # The text alone goes to Python, and the verdict comes back; all other columns stay where they are.
    @F.arrow_udf("struct<lang_pred: string, score: double, margin: double>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library_encoder.cache_clear()  # a worker that has encoded texts before holds their words
        grams, names, weights = model.value
        presence = Presence(grams)
        for raw in batches:
            said: list[str] = ["und"] * len(raw)
            score, margin = np.zeros(len(raw)), np.full(len(raw), np.nan)
            usable = np.flatnonzero(raw.is_valid().to_numpy(zero_copy_only=False)).tolist() if names else []
            for at in range(0, len(usable), BATCH):
                part = usable[at : at + BATCH]
                x = presence.rows([raw[i].as_buffer().to_pybytes() for i in part])
                found = (x @ weights) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
                ranked = np.sort(found, axis=1)
                margin[part] = ranked[:, -1] - (ranked[:, -2] if len(names) > 1 else 0)
                likely = np.clip((found.astype(np.float64) + 1) / 2, 1e-9, None)
                share = likely / likely.sum(1, keepdims=True)
                for i, best, s in zip(part, found.argmax(1), share, strict=True):
                    said[i], score[i] = names[best], s[best]
            yield pa.StructArray.from_arrays([pa.array(said, pa.string()), pa.array(score), pa.array(margin, from_pandas=True)], ["lang_pred", "score", "margin"])

    scored = F.when(F.col(text_col).rlike(r"\p{L}"), F.lower(text_col).cast("binary"))
    work = docs.select(
        *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], held_out(id_col, modulus, remainder).alias("held_out"),
        judge.asNondeterministic()(scored).alias("verdict"))
    return work.select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)], "held_out", "verdict.lang_pred", "verdict.score", "verdict.margin")


def predict_languages(
    docs: DataFrame, per_language: int = 250, sample_rows: int = 2000, landmarks: int = 240, ridge: float = 1.0, modulus: int = 4, remainder: int = 2,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None,
) -> DataFrame:
    """Predict the language of every whole text: doc_id, held_out, lang_pred, score, after the columns named in keep.

    The classifier learns from at most per_language texts of each language and sample_rows in all, whose crc32(id) mod
    modulus is not the remainder. The score is the winner's share of the positive scores. Texts that are null or hold no letter are `und`
    with score 0, and so is every text when nothing can be learned. Ties go to the first language by name. A null id is
    never learned from; repeated rows are predicted each. The model's size follows from its parameters, not the data.
    """
    return _predict(docs, per_language, sample_rows, landmarks, ridge, modulus, remainder, id_col, text_col, lang_col, keep).drop("margin")


def keep_languages(
    docs: DataFrame, languages: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """The documents in one of the languages, or in any that could be learned, with all columns, carried by place.

    A text whose winner is less than min_margin above the second is in none of them: it is in another language, noise, or
    too short or too mixed to tell. Texts that are null or hold no letter go too. If no document has a language to learn
    from, all others stay.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    places = [f"c{names.index(c)}" for c in (id_col, text_col, lang_col)]
    found = _predict(plain, id_col=places[0], text_col=places[1], lang_col=places[2], keep=plain.columns)
    wanted = F.col(places[1]).rlike(r"\p{L}") & F.coalesce(F.col("margin") >= min_margin, F.lit(True))
    if languages is not None:
        wanted &= F.col("lang_pred").isin(languages)
    return found.where(wanted).select(*plain.columns).toDF(*names)
