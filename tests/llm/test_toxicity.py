from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scoreloom.llm import toxicity
from tests.llm.helpers import awkward, docs

LABELS = "doc_id long, quality int, toxic int"


def labelled(spark):
    rng = random.Random(4)
    texts, marks = [], []
    for i in range(160):
        words = [f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randrange(20, 80))]
        if i % 4 == 0:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["vile", "rotten", "nasty"])
        texts.append(" ".join(words))
        marks.append((i, 1, int(i % 4 == 0)))
    return docs(spark, texts), spark.createDataFrame(marks, LABELS), texts


def test_tables_equal_the_formulas(spark, tmp_path):
    frame, marks, texts = labelled(spark)
    rows = frame.select(F.col("doc_id").alias("_id"), "text").join(marks.withColumnRenamed("doc_id", "_id"), "_id")
    model = toxicity._tables(toxicity._bigrams(rows.withColumn("apart", F.col("toxic") == 1)), toxicity._stems(rows), 10**6)
    bi = [Counter(), Counter()]
    for i, t in enumerate(texts):
        w = t.split()
        bi[int(i % 4 != 0)].update(zip(["<s>", *w], w))
    kinds = len(bi[0] | bi[1])
    n = [sum(b.values()) for b in bi]
    uni, ctx, followers, stems = ([Counter() for _ in range(2)] for _ in range(4))
    left = Counter(w for _, w in bi[0] | bi[1])
    for k in range(2):
        for (h, w), c in bi[k].items():
            uni[k][w] += c
            ctx[k][h] += c
            followers[k][h] += 1
            stems[k][w[: toxicity.STEM]] += c
    s, d = toxicity.SHARED, toxicity.DISCOUNT

    def word(k, w):
        share = (stems[0][w[:5]] + stems[1][w[:5]]) / sum(n)
        ratio = (stems[k][w[:5]] + s * share) / (n[k] + s) / share
        return (uni[k][w] + s * (left[w] + 1) / (kinds + 1) * ratio) / (n[k] + s)

    def pair(k, h, w):
        if not ctx[k][h]:
            return word(k, w)
        return (max(bi[k][h, w] - d, 0) + d * followers[k][h] * word(k, w)) / ctx[k][h]

    for t in texts[:40]:
        w = t.split()
        hashes, before, stem, _ = toxicity.words(pa.array([t]))
        got = model.differences(hashes, before, stem)
        for g, h, x in zip(got, ["<s>", *w], w):
            seen = bi[0][h, x] + bi[1][h, x] >= 3
            want = math.log(pair(0, h, x) / pair(1, h, x)) if seen else math.log(word(0, x) / word(1, x))
            if seen or uni[0][x] + uni[1][x] >= 2:
                assert g == pytest.approx(want, abs=1e-9)


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in entry.queries()["op6_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    marks = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(r.score, marks[i]) for i, r in got.items() if r.held_out and i in marks]
    ordered = [(a, b) for a, x in held for b, y in held if x == 1 and y == 0]
    assert np.mean([a > b for a, b in ordered]) > 0.75
    assert np.mean([(s >= 0.5) == (y == 1) for s, y in held]) > 0.85


def test_planted_texts_are_told_apart(spark):
    frame, marks, _ = labelled(spark)
    model = toxicity.learn(frame, marks, F.lit(True))
    new = docs(spark, ["w1 w2 vile w3 w4 w5 rotten w1 w9", "w1 w2 w3 w4 w5 w9 w1 w2 w7", "", None])
    score = {r.doc_id: r.score for r in toxicity.score_texts(new, model).collect()}
    assert score[0] > 0.5 and score[0] > score[1] + 0.2 and score[2] == score[3] < score[0]
    again = toxicity.learn(frame.repartition(7), marks.unionByName(marks), F.lit(True))
    assert np.allclose(again.curve, model.curve, atol=1e-6)


@pytest.mark.parametrize("marks, want", [([], 0.0), ([(4, 0, 0), (6, 0, 0)], 0.0), ([(4, 0, 1)], 1.0), ([(4, None, None)], 0.0)])
def test_awkward_rows(spark, marks, want):
    frame = awkward(spark).withColumnRenamed("lang", "toxic").withColumnRenamed("source", "_id")
    model = toxicity.learn(frame, spark.createDataFrame(marks, LABELS), F.lit(True))
    got = toxicity.score_texts(frame, model).collect()
    assert len(got) == 10 and all(abs(r.score - want) < 1e-9 for r in got)
    assert toxicity.score_texts(docs(spark, []), model).count() == 0
