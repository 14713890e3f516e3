from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scoreloom.llm import simhash
from tests.llm.helpers import awkward, docs

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes):
    """node -> smallest node reachable over links of at most two bits."""
    nodes, out = sorted(set(nodes)), {}
    for start in nodes:
        if start in out:
            continue
        out[start], todo = start, [start]
        while todo:
            a = todo.pop()
            for b in nodes:
                if b not in out and (a ^ b).bit_count() <= 2:
                    out[b] = start
                    todo.append(b)
    return out


def brute(rows):
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    own = classes(p for _, p in prints)
    least = {}
    for i, p in prints:
        if i is not None:
            least[own[p]] = min(least.get(own[p], i), i)
    return sorted(((i, f"{p:016x}", least.get(own[p])) for i, p in prints), key=str)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = entry.queries()["op12_simhash_near_dedup"](spark, sf_dir)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == brute(rows) and any(i != c for i, _, c in got)


def test_awkward_and_empty_tables(spark):
    frame = awkward(spark).withColumn("bits", F.lit("x")).withColumn("key", F.lit(1)).withColumn("n", F.lit(2))
    got = sorted(map(tuple, simhash.near_duplicates(frame).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in frame.collect()])
    assert simhash.near_duplicates(frame.limit(0)).count() == 0
    only_null = simhash.near_duplicates(frame.where("doc_id IS NULL")).collect()
    assert len(only_null) == 1 and only_null[0].component_id is None


def test_words_as_stated(spark):
    texts = ["A b\tC\x0bd", "a b c d", "Ä b c d", "ä b c d", "a b c d", "Two words", "one", " "]
    frame = docs(spark, texts)
    got = {r.doc_id: r.bits & (1 << 64) - 1 for r in simhash.fingerprints(frame).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in enumerate(texts)}


def test_long_texts_are_cut_without_change(monkeypatch):
    text = " \n ".join(f"w{i * i % 71} x" for i in range(500)).encode()
    whole = simhash.fingerprint(text)
    assert whole == brute_fingerprint(text.decode())
    for size in (1, 7, 300):
        monkeypatch.setattr(simhash.pieces, "__defaults__", (size,))
        assert simhash.fingerprint(text) == whole


@pytest.mark.parametrize("small", [1, 2, 4, 64])
def test_links_of_dense_groups(spark, small):
    """Many fingerprints around a few centres; small groups force the finer indexes."""
    rng = random.Random(small)
    nodes = {0, (1 << 64) - 1, 1 << 63, 1}
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            flips = rng.sample(range(64), rng.choice([0, 1, 2, 3, 3, 4]))
            nodes.add(centre ^ sum(1 << b for b in flips))
    half = rng.getrandbits(32) << 32  # one half in common
    nodes |= {half | rng.getrandbits(32) for _ in range(40)} | {half | 1 << rng.randrange(32) | 1 << rng.randrange(32) for _ in range(60)}
    want = {(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 2}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(n),) for n in sorted(nodes)], "bits long").repartition(5)
    pairs = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(frame, len(nodes), small).collect()]
    assert {(min(p), max(p)) for p in pairs} == want
    if small == 64:
        assert len(pairs) < 64 * len(nodes) * 8


def test_groups_over_batch_bounds(spark):
    """A group larger than an Arrow batch is passed on as it comes, whole."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        nodes = [5 << 40 | 1 << i | 1 << j for i in range(12) for j in range(12)]
        frame = spark.createDataFrame([(n,) for n in sorted(set(nodes))], "bits long")
        pairs = {tuple(sorted(r)) for r in simhash.links(frame, len(set(nodes)), 8).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    nodes = sorted(set(nodes))
    assert pairs == {(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 2}
