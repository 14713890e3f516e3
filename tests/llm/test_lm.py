from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scoreloom.llm import lm
from tests.llm.helpers import awkward, docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "</s>"]


def brute(rows, steps=lm.STEPS):
    """rows: (id, text, train, held); the same model with dictionaries."""
    def counts(chosen):
        uni, bi, ctx = Counter(), Counter(), Counter()
        for _, text, *_ in chosen:
            t = tokens(text)
            uni.update(t)
            bi.update(zip(["<s>", *t], t))
            ctx.update(["<s>", *t[:-1]])
        return uni, bi, ctx

    uni, bi, ctx = counts([r for r in rows if r[2]])
    hu, hb, hc = counts([r for r in rows if r[2] and r[3]])
    total, kinds = sum(uni.values()), len(uni)
    left = total - sum(hu.values())
    bucket = lambda c: 0 if c == 0 else c.bit_length()
    weights = {b: np.full(3, 1 / 3) for b in range(64)}
    weights[0] = np.array([0, 0.5, 0.5])
    if not left:
        weights = {b: np.array([0.0, 0, 1]) for b in range(64)}

    def estimates(c, h, w, n):
        return np.array([c / h if h else 0, w / n if n else 0, 1 / (kinds + 1)])

    for _ in range(steps if left else 0):
        sums = {}
        for (h, w), n in hb.items():
            c = ctx[h] - hc[h]
            e = estimates(bi[h, w] - n, c, uni[w] - hu[w], left) * weights[bucket(c)]
            sums[bucket(c)] = sums.get(bucket(c), 0) + n * e / e.sum()
        for b, s in sums.items():
            s = s / s.sum()
            s[2] = max(s[2], lm.LEAST)
            weights[b] = s / s.sum()
    out = []
    for i, text, *_ in rows:
        t = tokens(text)
        score = sum(math.log10((estimates(bi[h, w], ctx[h], uni[w], total) * weights[bucket(ctx[h])]).sum()) for h, w in zip(["<s>", *t], t))
        base = sum(math.log10((uni[w] + 1) / (total + kinds + 1)) for w in t)
        out.append((i, len(t), sum(uni[w] > 0 for w in t), total, base, score))
    return out


def same(got, want):
    key = lambda r: tuple(-1 if x is None else x for x in r)
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4]
        assert g[4:] == pytest.approx(w[4:], rel=1e-9, abs=1e-9)


def test_query_equals_brute_force(spark, sf_dir):
    got = entry.queries()["op5_interpolated_lm"](spark, sf_dir).collect()
    fold = lambda i: zlib.crc32(str(i).encode()) % 7
    rows = [(r.doc_id, r.text, fold(r.doc_id) != 2, fold(r.doc_id) == 3) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    same([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], brute(rows))
    assert all(r.held_out == (fold(r.doc_id) == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_many_small_blocks(spark, sf_dir, monkeypatch):
    """Counts must not depend on how rows fall into blocks and buckets."""
    monkeypatch.setattr(lm, "BUCKET_BYTES", 1 << 14)
    texts = ["the cat sat on the mat", "the cat ran", None, "", "A a\tA\na", "the dog sat on the cat"] * 5
    rows = [(i, t, i % 4 != 1, i % 4 == 2) for i, t in enumerate(texts)]
    frame = docs(spark, texts).repartition(7)
    got = lm.score_texts(frame, F.col("doc_id") % 4 != 1, F.col("doc_id") % 4 == 2).collect()
    same(got, brute(rows))


def test_awkward_rows(spark):
    frame = awkward(spark).withColumnRenamed("lang", "train").withColumnRenamed("source", "keys")
    rows = [(r.doc_id, r.text, bool(r.doc_id and r.doc_id % 2), r.doc_id == 5) for r in frame.collect()]
    got = lm.score_texts(frame, F.col("doc_id") % 2 == 1, F.col("doc_id") == 5).collect()
    same(got, brute(rows))
    assert lm.score_texts(docs(spark, []), F.lit(True), F.lit(False)).count() == 0


def test_without_training_rows(spark):
    rows = [(0, "a b", False, False), (1, None, False, False)]
    same(lm.score_texts(docs(spark, ["a b", None]), F.lit(False), F.lit(False)).collect(), brute(rows))
