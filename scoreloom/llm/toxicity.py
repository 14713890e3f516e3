"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models of interpolated Kneser-Ney form, one of toxic and one of ordinary
texts, give each text two log-likelihoods; their difference by token is what a text is
judged by. Rare expressions are smoothed by backoff counts that both classes share:

    P_k(w | h) = max(c_k(h, w) - D, 0) / c_k(h) + D n_k(h) / c_k(h) P_k(w)
    P_k(w)     = (c_k(w) + S C(w) R_k(s)) / (c_k + S)
    R_k(s)     = (c_k(s) + S C(s)) / (c_k + S) / C(s)

c_k(h, w) counts a bigram in class k, n_k(h) its distinct followers of h, and C(w) is the
Kneser-Ney continuation share of w: its distinct left neighbours in either class over all
distinct bigrams, one added. s is the beginning of the word (`STEM` bytes) and C(s) its share
in both classes. With little of a word in a class both models fall back to the same shared
counts, so that what was not learned says nothing.

The length-normalised difference over all tokens, that of its strong words alone, and the
length itself are calibrated to a probability by a logistic curve. It is fitted to a quarter of the training rows, with
models of the other three; the models that score learn from all of them.

Plan. The models learn from at most `MOST_ROWS` labelled rows (a documented bound; those
of the smallest id hash, so that the choice does not depend on the input's order), whose
counts are aggregates; the model, with entries for expressions that speak for or against
(`MOST_ENTRIES` at most, by the weight they carry), is a bounded table that reaches the
tasks in the closure of the scoring pass. That pass is one scan over all whole texts,
without a shuffle; a hot source or a group of copies costs what its rows cost.

Defined results: null or empty texts get the calibrated score of no evidence; without labels of both
classes every score is the share of toxic labels, 0 without any; a text with several labels
is toxic if one of them is; repeated rows each return a row, and are learned once; only the id is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import packed
from scoreloom.session import work_path

MOST_ROWS = 40_000
MOST_ENTRIES = 300_000
DISCOUNT, SHARED = 0.75, 200.0
BLOCK_BYTES = 2 << 20
STEM = 5
_U = np.uint64
_ODD, _BEGIN = _U(0xD1342543DE82EF95), _U(0x14057B7EF767814F)

# A-Z folded, everything but ASCII letters, digits and other characters parts words.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[[*range(48, 58), *range(97, 123)]] = [*range(48, 58), *range(97, 123)]
_FOLD[65:91] = np.arange(97, 123)


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, of the words before them and of their stems, and the word ranges of the rows."""
    data, offsets = packed.text_bytes(column)
    data = _FOLD[data]
    starts, ends, row = packed.word_bounds(data, offsets)
    sums = packed.byte_sums(data)
    word, stem = packed.span_hash(sums, starts, ends), packed.span_hash(sums, starts, np.minimum(ends, starts + STEM))
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    before = np.empty(len(word), np.uint64)
    before[1:] = word[:-1]
    before[bounds[:-1][bounds[:-1] < bounds[1:]]] = _BEGIN
    return word, before, stem, bounds


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return packed.mix(before * _ODD + packed.mix(word))


_COUNTS = ["t", "o", "ta", "oa"]  #: toxic and ordinary, in all rows and in the quarter apart


def _count_rows(batches):
    """(h, w) of a block's distinct bigrams, word before and word, with `_COUNTS`."""
    for _, rows in packed.blocks(batches, "text", BLOCK_BYTES):
        word, before, _, bounds = words(rows.column("text"))
        toxic = np.repeat(rows.column("toxic").to_numpy(zero_copy_only=False) == 1, np.diff(bounds))
        apart = np.repeat(rows.column("apart").to_numpy(zero_copy_only=False), np.diff(bounds))
        pairs, at = np.unique(np.stack([before, word], 1), axis=0, return_inverse=True) if len(word) else (np.zeros((0, 2), np.uint64), np.zeros(0, np.int64))
        at = at.reshape(-1)
        counts = [np.bincount(at[chosen], minlength=len(pairs)) for chosen in (toxic, ~toxic, toxic & apart, ~toxic & apart)]
        own = [pa.array(pairs[:, i].copy().view(np.int64)) for i in range(2)]
        yield pa.record_batch([*own, *[pa.array(c, pa.int64()) for c in counts]], names=["h", "w", *_COUNTS])


def _word_stems(batches):
    """(w, s) of a block's distinct words."""
    for _, rows in packed.blocks(batches, "text", BLOCK_BYTES):
        word, _, stem, _ = words(rows.column("text"))
        word, at = np.unique(word, return_index=True)
        yield pa.record_batch([pa.array(word.view(np.int64)), pa.array(stem[at].view(np.int64))], names=["w", "s"])


class Model:
    """Log-likelihood differences of bigrams, words and stems, in order of their keys, and the curve."""

    def __init__(self, stems=None, words_=None, pairs=None):
        none = (np.zeros(0, np.uint64), np.zeros(0))
        self.tables = [none if t is None else t for t in (stems, words_, pairs)]
        self.curve = np.zeros(len(FEATURES) + 1)
        self.scale = (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))

    def differences(self, word: np.ndarray, before: np.ndarray, stem: np.ndarray) -> np.ndarray:
        """log P_toxic(w | h) - log P_ordinary(w | h) for each token: by bigram, else word, else stem."""
        out = np.zeros(len(word))
        for (keys, values), wanted in zip(self.tables, (stem, word, pair_key(before, word))):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                out = np.where(keys[at] == wanted, values[at], out)
        return out

    def features(self, column: pa.Array) -> np.ndarray:
        word, before, stem, bounds = words(column)
        llr = self.differences(word, before, stem)
        n = np.diff(bounds)
        sums = np.concatenate([[0.0], np.cumsum(llr)])
        strong = np.concatenate([[0.0], np.cumsum(np.maximum(llr - 1.0, 0.0))])
        count = np.concatenate([[0], np.cumsum(llr > 2.0)])
        first, last = bounds[:-1], bounds[1:]
        mean = (sums[last] - sums[first]) / np.maximum(n, 1)
        high = (strong[last] - strong[first])
        rate = high / np.maximum(n, 1)
        hits = (count[last] - count[first])
        return np.stack([mean, rate * 10, np.sqrt(np.maximum(rate, 0)), np.log1p(high), np.log1p(hits), np.minimum(hits / np.maximum(n, 1) * 20, 3.0), np.log1p(n)], 1)

    def scores(self, column: pa.Array) -> np.ndarray:
        x = (self.features(column) - self.scale[0]) / self.scale[1]
        z = x @ self.curve[:-1] + self.curve[-1]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


FEATURES = ("mean", "rate", "root", "strong", "hits", "hit_rate", "length")


def _training(docs: DataFrame, labels: DataFrame, train: Column, id_column: str, text: str, most_rows: int) -> DataFrame:
    """At most `most_rows` rows (_id, text, toxic). They are chosen by id and hash before any text moves."""
    marks = labels.where(F.col("toxic").isNotNull()).groupBy(F.col(id_column).cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.where(train).select(F.col(id_column).cast("long").alias("_id"), F.xxhash64(text).alias("_h"), F.col(text).alias("text"))
    chosen = rows.select("_id", "_h").distinct().join(marks, "_id").orderBy(F.xxhash64("_id"), "_id", "_h").limit(most_rows)
    # The chosen keys are bounded by `most_rows`, 20 bytes each.
    return rows.join(F.broadcast(chosen), ["_id", "_h"]).dropDuplicates(["_id", "_h"]).select("_id", "text", "toxic")


def learn(
    docs: DataFrame, labels: DataFrame, train: Column, id_column: str = "doc_id", text: str = "text",
    most_rows: int = MOST_ROWS, most_entries: int = MOST_ENTRIES,
) -> Model:
    """The model of the labelled rows that `train` marks; `labels` has the id and `toxic`."""
    path = work_path(docs.sparkSession, "toxicity")
    rows = packed.staged(_training(docs, labels, train, id_column, text, most_rows), f"{path}/rows").repartition(packed.parts(most_rows, 4000), "_id")
    apart = F.pmod(F.xxhash64(F.lit("apart"), "_id"), F.lit(4)) == 0
    # Both models' counts come from one pass: those of the quarter apart are columns of their own.
    grams = packed.staged(_bigrams(rows.withColumn("apart", apart)), f"{path}/grams")
    stems = packed.staged(_stems(rows), f"{path}/stems")
    most = grams.select("h", "w", (F.col("t") - F.col("ta")).alias("t"), (F.col("o") - F.col("oa")).alias("o")).where("t + o > 0")
    model, trial = (_tables(x, stems, most_entries) for x in (grams.select("h", "w", "t", "o"), most))
    share = rows.agg(F.avg("toxic")).first()[0]
    if not share or share >= 1 or not len(model.tables[0][0]):
        model.curve[-1] = -30.0 if not share else 30.0 if share >= 1 else np.log(share / (1 - share))
        return model
    _calibrate(trial, rows.where(apart), float(share))
    model.curve, model.scale = trial.curve, trial.scale
    return model


def _bigrams(rows: DataFrame) -> DataFrame:
    """Distinct bigrams (h, w) of rows (text, toxic, apart), with `_COUNTS`."""
    counted = rows.mapInArrow(_count_rows, f"h long, w long, {', '.join(f'{c} long' for c in _COUNTS)}")
    return counted.groupBy("h", "w").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def _stems(rows: DataFrame) -> DataFrame:
    """The stem s of every distinct word w of rows."""
    return rows.select("text").mapInArrow(_word_stems, "w long, s long").groupBy("w").agg(F.min("s").alias("s"))


def _tables(grams: DataFrame, stems: DataFrame, most_entries: int) -> Model:
    """The Kneser-Ney differences of distinct bigrams (h, w) with their counts t and o by class."""
    nt, no, kinds = (float(x or 0) for x in grams.agg(F.sum("t"), F.sum("o"), F.count("*")).first())
    if not nt or not no:
        return Model()
    total, part = nt + no, lambda c, n, share: (F.col(c) + SHARED * share) / (n + SHARED)
    uni = grams.groupBy("w").agg(F.sum("t").alias("t"), F.sum("o").alias("o"), F.count("*").alias("left")).join(stems, "w")
    stem = uni.groupBy("s").agg(F.sum("t").alias("st"), F.sum("o").alias("so"))
    share = (F.col("st") + F.col("so")) / total
    stem = stem.select("s", "st", "so", (part("st", nt, share) / share).alias("rt"), (part("so", no, share) / share).alias("ro"))
    stem = stem.withColumn("llr", F.log(F.col("rt") / F.col("ro")))
    # Kneser-Ney continuation counts of both classes together.
    uni = uni.join(stem.select("s", "rt", "ro"), "s")
    share = (F.col("left") + 1) / (kinds + 1)
    uni = uni.select("w", "t", "o", part("t", nt, share * F.col("rt")).alias("pt"), part("o", no, share * F.col("ro")).alias("po"))
    uni = uni.withColumn("llr", F.log(F.col("pt") / F.col("po")))
    context = grams.groupBy("h").agg(
        F.sum("t").alias("ht"), F.sum("o").alias("ho"), F.sum((F.col("t") > 0).cast("long")).alias("mt"), F.sum((F.col("o") > 0).cast("long")).alias("mo")
    )
    # Mass that a context leaves to the backoff; all of it where a class has not seen the context.
    left = lambda h, m: F.when(F.col(h) > 0, DISCOUNT * F.col(m) / F.col(h)).otherwise(1.0)
    seen = lambda c, h: F.when(F.col(h) > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(h)).otherwise(0.0)
    bi = grams.where("t + o >= 3").join(uni.select("w", "pt", "po"), "w").join(context, "h")
    bi = bi.withColumn("llr", F.log(
        (seen("t", "ht") + left("ht", "mt") * F.col("pt")) / (seen("o", "ho") + left("ho", "mo") * F.col("po"))
    ))
    own = lambda t, c: t.column(c).to_numpy().view(np.uint64)

    def entries(frame: DataFrame, columns: list[str], key, weight):
        top = frame.select(*columns, "llr", (F.abs("llr") * weight).alias("carried"))
        top = top.orderBy(F.desc("carried"), *columns).limit(most_entries).toArrow()
        keys, values = key(top), top.column("llr").to_numpy()
        order = np.argsort(keys)
        return keys[order], values[order]

    both = F.col("t") + F.col("o")
    return Model(
        entries(stem, ["s"], lambda x: own(x, "s"), F.col("st") + F.col("so")),
        entries(uni.where("t + o >= 2"), ["w"], lambda x: own(x, "w"), both),
        entries(bi, ["h", "w"], lambda x: pair_key(own(x, "h"), own(x, "w")), both),
    )


def _feature_rows(model: Model):
    def run(batches):
        for _, part in packed.blocks(batches, "text", BLOCK_BYTES):
            x = model.features(part.column("text"))
            yield pa.record_batch({"x": pa.array(x.tolist(), pa.list_(pa.float64())), "toxic": part.column("toxic")})

    return run


def _calibrate(model: Model, rows: DataFrame, share: float, steps: int = 60) -> None:
    """Logistic curve over the features, by Newton steps; rows are bounded by `most_rows`."""
    data = rows.select("text", "toxic").mapInArrow(_feature_rows(model), "x array<double>, toxic int").toArrow()
    if not data.num_rows:
        model.curve[-1] = np.log(share / (1 - share))
        return
    x = np.stack(data.column("x").to_numpy())
    y = data.column("toxic").to_numpy().astype(float)
    mean, deviation = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / deviation, np.ones(len(x))])
    curve = np.zeros(z.shape[1])
    ridge = np.diag([0.5] * (z.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ curve, -30, 30)))
        gradient = z.T @ (p - y) + ridge @ curve
        curve -= np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge, gradient)
        if np.abs(gradient).max() < 1e-8:
            break
    model.curve, model.scale = curve, (mean, deviation)


def _scorer(model: Model):
    def run(batches):
        for _, part in packed.blocks(batches, "text", BLOCK_BYTES):
            yield pa.record_batch({"doc_id": part.column("doc_id"), "score": pa.array(model.scores(part.column("text")))})

    return run


def score_texts(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and `score` (0 to 1) of every row."""
    plain = docs.selectExpr(f"cast(`{id_column}` as bigint) AS doc_id", f"`{text}` AS text")
    return plain.mapInArrow(_scorer(model), "doc_id long, score double")
