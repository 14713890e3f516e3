from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scoreloom.llm import divergence
from tests.llm.helpers import DOCS, awkward
from tests.oracle import connect, differences

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least=30, top=50):
    """`rows`: (text, lang, source)."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: c for (g, s), c in counts.items() if g == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(sum(groups.values(), Counter()))
        p = {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -v, r) for r, (v, _, item) in enumerate(found, 1)}
    return out


def rows_of(frame):
    return [(r.text, r.lang, r.source) for r in frame.collect()]


def test_query_equals_sql_and_brute_force(spark, sf_dir):
    got = entry.queries()["op11_source_divergence"](spark, sf_dir)
    assert dict(got.dtypes) == {
        "lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"
    }
    found = [tuple(r) for r in got.collect()]
    want = brute(rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    assert len(found) == len(set(found)) and set(found) == want
    assert {part for _, _, part, *_ in want} == {"pair", "term"}
    assert differences(got, connect(sf_dir), entry.oracle_sql()["op11_source_divergence"]) is None


@pytest.mark.parametrize("sources, chunk, step", [(256, 20_000, 256), (3, 4, 2), (1, 1, 1)])
def test_small_blocks_give_the_same(spark, monkeypatch, sources, chunk, step):
    """Many terms of equal counts (ties by bytes), many sources, every constant small."""
    for name, value in (("SOURCES", sources), ("CHUNK", chunk), ("STEP", step), ("BLOCK", 400)):
        monkeypatch.setattr(divergence, name, value)
    rng = random.Random(sources)
    words = ["Ärger", "zebra", "ähre", "apfel", "bÄr", "字", "字母", "q" * 30] + [f"t{chr(97 + i)}" for i in range(20)]
    rows = [
        (i, " ".join(rng.choices(words, k=rng.randrange(12))) + "1x_X", rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "ä", "é", "", None]), 1)
        for i in range(120)
    ]
    rows.append((None, "12 34", "fr", "only", 1))
    rows.append((None, None, "fr", "other", 1))
    frame = spark.createDataFrame(rows, DOCS).repartition(6)
    for least, top in ((1, 3), (3, 50), (500, 5)):
        got = [tuple(r) for r in divergence.audit(frame, least_docs=least, top=top).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows_of(frame), least, top)


def test_awkward_and_empty_tables(spark):
    frame = awkward(spark).withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).withColumn("number", F.lit(2))
    got = {tuple(r) for r in divergence.audit(frame, least_docs=1).collect()}
    assert got == brute(rows_of(frame), 1)
    assert divergence.audit(frame.limit(0)).count() == 0


def test_skyband_is_exact():
    rng = np.random.default_rng(4)
    for n, k in ((0, 1), (1, 1), (300, 1), (700, 5), (900, 50)):
        a, b, c = rng.integers(0, 9, n), rng.integers(0, 9, n), rng.permutation(n)
        over = (a[None] >= a[:, None]) & (b[None] <= b[:, None]) & (c[None] <= c[:, None])
        want = np.flatnonzero(over.sum(1) - 1 < k) if n else np.zeros(0)
        assert divergence.skyband(a, b, c, k).tolist() == want.tolist()


def test_shares_beyond_64_bits(spark):
    count, total = 10**13 + 7, 3 * 10**15 + 11
    frame = spark.sql(f"SELECT {count}L AS n, {total}L AS total, 1000L AS terms")
    got = frame.select(divergence.share(F.col("n"), F.col("total"), F.col("terms")).alias("p")).first().p
    assert got == 1 + 10**9 * (count + 5) // (total + 5000)
