from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from scoreloom.llm import components, jaccard
from tests.llm.helpers import awkward, docs
from tests.llm.test_lm import LOWER


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """rows: (id, text); classes by comparing all pairs that share a shingle."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = {}
    for at, (i, s) in enumerate(sets):
        for x in s if i is not None else ():
            holders.setdefault(x, []).append(at)
    shared = Counter((a, b) for h in holders.values() for k, a in enumerate(h) for b in h[:k])
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            x, y = sorted((find(sets[a][0]), find(sets[b][0])))
            parent[y] = x
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]


def key(row):
    return tuple(-1 if x is None else x for x in row)


def test_query_equals_brute_force(spark, sf_dir):
    got = entry.queries()["op9_partenum_join"](spark, sf_dir).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("size", [7, 9, 14, 25, 60, 300])
def test_linked_sets_share_a_signature(size):
    """The promise of the method, near the limit and at every size."""
    rng = random.Random(size)
    for _ in range(150):
        first = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        second = edited(rng, first, rng.randrange(1, 2 + size // 25)) + [f"x{i}" for i in range(rng.randrange(0, 2 + size // 6))]
        a, b = shingles(" ".join(first)), shingles(" ".join(second))
        sets = jaccard.shingle_sets(pa.array([" ".join(first), " ".join(second)]))
        assert [len(s) for s in sets] == [len(a), len(b)]
        if 100 * len(a & b) >= 75 * len(a | b) and a != b:
            for common in (None, sets[0][::2], sets[0], sets[1][:3]):
                keys, owners = jaccard.signatures(sets, None if common is None else np.sort(common))
                assert set(keys[owners == 0]) & set(keys[owners == 1])


def test_families_of_copies_and_half_similar_texts(spark):
    """Stars, failed stars, half-similar groups and chains give the same classes as all pairs."""
    rng, texts = random.Random(3), []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(60)]
        texts += [" ".join(edited(rng, base, rng.randrange(0, 3))) for _ in range(40)]
        half = base[:45] + [f"h{family}w{i}" for i in range(20)]
        texts += [" ".join(edited(rng, half, rng.randrange(0, 2))) for _ in range(25)]
        texts += [" ".join(base[k : k + 50]) for k in range(0, 11)]
    texts += ["a b c", "A  b\tc", "a b c d", None, "", "a b c d e", "a b c d e f", "a b c d e f g"] + ["same text here"] * 50
    rng.shuffle(texts)
    got = jaccard.near_duplicates(docs(spark, texts).repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(brute(list(enumerate(texts))))


@pytest.mark.parametrize("rounds, small", [(1, 2), (4, 2), (4, 3)])
def test_stars_and_the_pairs_after_the_last_round(spark, monkeypatch, rounds, small):
    monkeypatch.setattr(jaccard._links, "__defaults__", (rounds,))
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard.candidates, "__defaults__", (small,))
    test_families_of_copies_and_half_similar_texts(spark)


def test_awkward_rows(spark):
    frame = awkward(spark).withColumnRenamed("lang", "name").withColumnRenamed("source", "node")
    got = jaccard.near_duplicates(frame).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute([(r.doc_id, r.text) for r in frame.collect()]), key=key)
    assert jaccard.near_duplicates(docs(spark, [])).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 300)] + [(7, 7)]
    got = components.smallest_member(spark.createDataFrame(links, "a long, b long")).collect()
    want = {(i, 0) for i in range(1, 41)} | {(x, 100) for x in range(101, 300)}
    assert {tuple(r) for r in got} == want


def open_sets(spark, texts):
    names = jaccard.set_hashes(jaccard.shingle_sets(pa.array(texts))).view(np.int64).tolist()
    return spark.createDataFrame([(n, t, n) for n, t in zip(names, texts)], "name long, text string, label long")


def test_alike_sets_that_do_not_link_do_not_meet(spark):
    rng, base = random.Random(5), [f"w{i}" for i in range(100)]
    texts = [" ".join(edited(rng, base, 9)) for _ in range(150)] + [" ".join(base), " ".join([*base[:-1], "end"])]
    left = open_sets(spark, texts)
    got = {(r.a, r.b) for r in jaccard.open_pairs(left, 12).collect()}
    names = [r.name for r in left.collect()]
    last = sorted(names[-2:], key=lambda x: x % 2**64)
    assert tuple(last) in got and len(got) < 10 * len(texts)  # of 11,476 pairs, all of which share a signature


@pytest.mark.parametrize("rounds, piece", [(1, 2), (1, 5)])
def test_pieces_of_groups_lose_no_link(spark, monkeypatch, rounds, piece):
    monkeypatch.setattr(jaccard, "PIECE", piece)
    monkeypatch.setattr(jaccard._links, "__defaults__", (rounds,))
    test_families_of_copies_and_half_similar_texts(spark)


def test_sketches_bound_the_difference_at_any_size():
    rng = np.random.default_rng(4)
    for n, m, both in ((5, 6, 5), (100, 120, 90), (3000, 2500, 2300), (50_000, 45_000, 44_000), (900, 1300, 0)):
        pool = np.unique(rng.integers(0, 1 << 62, n + m, dtype=np.int64).astype(np.uint64))
        rng.shuffle(pool)
        x, y = np.sort(pool[:n]), np.sort(np.concatenate([pool[:both], pool[n : n + m - both]]))
        apart = len(np.setxor1d(x, y))
        s, t = jaccard.sketches([x, y])
        width = min(len(s), len(t))
        bits = int(np.bitwise_count(jaccard.folded(s[None], width) ^ jaccard.folded(t[None], width)).sum())
        assert bits <= apart and (apart - bits) % 2 == 0
        assert 7 * apart <= n + m or 2 * both > n or 7 * bits > n + m  # unlike sets are told apart, long ones too
    assert jaccard.sketches([]) == []
    assert [len(x) for x in jaccard.sketches([np.zeros(0, np.uint64), y])] == [128, 256]


@pytest.mark.parametrize("most", [0, jaccard.MOST_NAMES])
def test_texts_by_broadcast_and_by_join(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(jaccard, "MOST_NAMES", most)
    frame = docs(spark, ["a b c d e f g h", "a b c d e f g h", "i j k l m n o p q", None])
    name = jaccard.set_hashes(jaccard.shingle_sets(pa.array(["a b c d e f g h"]))).view(np.int64).tolist()
    names = spark.createDataFrame([(n,) for n in name * 3 + [5]], "name long")
    got = jaccard._packed_texts(frame, names, str(tmp_path / "texts")).collect()
    assert [r.name for r in got] == name
