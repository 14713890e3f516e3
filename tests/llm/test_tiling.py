from __future__ import annotations

import random
import re

import numpy as np
import pytest

import __spark_entry__ as entry
from scoreloom.llm import tiling
from tests.llm.helpers import awkward, docs
from tests.llm.test_lm import LOWER


def words(text):
    """Tokens, character by character."""
    out, joined = [], False
    for c in (text or "").translate(LOWER):
        within = lambda ranges: any(a <= ord(c) <= b for a, b in ranges)  # noqa: B023, E731
        if within(tiling.SINGLE):
            out, joined = [*out, c], False
        elif within(tiling.PARTING) or not re.match(r"[a-z0-9\x80-\U0010ffff]", c):
            joined = False
        else:
            out, joined = ([*out[:-1], out[-1] + c], True) if joined else ([*out, c], True)
    return out


def brute_tiles(a, b, least):
    """Greedy string tiling as Wise states it, by comparing every pair of places."""
    free_a, free_b, total, tiles = [True] * len(a), [True] * len(b), 0, 0
    while True:
        best, found = least - 1, []
        for j in range(len(b)):
            for i in range(len(a)):
                n = 0
                while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                    n += 1
                if n > best:
                    best, found = n, []
                if n == best and n >= least:
                    found.append((i, j))
        if not found:
            return total, tiles
        for i, j in found:
            if all(free_a[i : i + best]) and all(free_b[j : j + best]):
                free_a[i : i + best] = free_b[j : j + best] = [False] * best
                total, tiles = total + best, tiles + 1


def brute(rows, items, least=tiling.LEAST, threshold=tiling.THRESHOLD, shortest=tiling.SHORTEST):
    out, split = [], [(i, words(text)) for i, text in rows]
    for k, item in items:
        a = words(item)
        n = min(least, len(a))
        grams = {tuple(a[i : i + n]) for i in range(len(a) - n + 1)}
        for i, b in split:
            if not n or (n < shortest and a != b):
                continue
            if any(tuple(b[j : j + n]) in grams for j in range(len(b) - n + 1)):
                covered, tiles = brute_tiles(a, b, n)
                if covered >= threshold * len(a):
                    out.append((i, k, covered, len(a), tiles))
    return out


def test_query_equals_brute_force(spark, sf_dir):
    got = entry.queries()["op4_string_tiling"](spark, sf_dir).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = brute(rows, items)
    assert sorted(map(tuple, got)) == sorted(want) and want


@pytest.mark.parametrize("seeds", [tiling.BROADCAST_SEEDS, 0])
def test_reordered_passages_are_caught_and_chance_is_not(spark, monkeypatch, seeds):
    monkeypatch.setattr(tiling, "BROADCAST_SEEDS", seeds)
    rng = random.Random(1)
    items = [" ".join(f"t{k}x{rng.randrange(40)}" for _ in range(40)) for k in range(5)] + ["one two", None, ""]
    texts = []
    for _ in range(40):
        w = rng.choice(items[:5]).split()
        n = rng.choice([4, 6, 10, 20])
        parts = [w[i : i + n] for i in range(0, 40, n)]
        rng.shuffle(parts)
        noise = [f"n{rng.randrange(50)}" for _ in range(rng.randrange(0, 50))]
        texts.append(" ".join([*noise, *[x for p in parts[: rng.randrange(1, 1 + len(parts))] for x in [*p, "Filler."]], *noise]).upper())
    texts += [texts[0], "one two", None, ""]
    frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = tiling.contaminated(docs(spark, texts), frame).collect()
    want = brute(list(enumerate(texts)), list(enumerate(items)))
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 10


def test_tiles_of_repetitive_strings(spark):
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(3) for _ in range(rng.randrange(25))] for _ in range(2))
        tiles = tiling.tile(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        assert (sum(n for *_, n in tiles), len(tiles)) == brute_tiles(a, b, 3)


def test_awkward_rows(spark):
    frame = awkward(spark).withColumnRenamed("lang", "name").withColumnRenamed("source", "item")
    long = frame.where("doc_id = 4").first().text
    items = spark.createDataFrame([(1, " ".join(long.split()[200:260]), 0), (1, " ".join(long.split()[200:260]), 0), (None, "no id here at all", 0)], "item_id long, text string, key int")
    got = sorted((r.doc_id or -1, r.item_id or -1, r.covered) for r in tiling.contaminated(frame, items).collect())
    assert got == [(-1, -1, 5), (4, 1, 60), (4, 1, 60), (5, 1, 60), (5, 1, 60)]
    assert tiling.contaminated(docs(spark, []), items).count() == 0
    assert tiling.contaminated(frame, items.limit(0)).count() == 0


def test_short_items_and_scripts_without_spaces(spark):
    han = "\u4e2d\u56fd\u7684\u9996\u90fd\u662f\u5317\u4eac\u3002\u6cb3\u6d41\u5f88\u957f\uff0c\u57ce\u5e02\u5f88\u5927"
    items = ["four words in all", "two words", "word", han, "\u0e01\u0e02\u0e03\u0e04\u0e05\u0e06", "caf\u00e9\u2014na\u00efve \u00abr\u00f4le\u00bb d\u00e9j\u00e0 vu", "\u3002!", "", None]
    texts = [
        "Before. Four words, in all! After.", "four words in", "two words", "here are two words", "word", "a word", han, f"abc{han[9:]}xyz{han[:8]}1", han[:6],
        "\u0e00\u0e01\u0e02\u0e03\u0e04\u0e05\u0e06\u0e07", "x caf\u00e9 na\u00efve r\u00f4le d\u00e9j\u00e0 vu", "cafe naive role deja vu", "\u3002!", "", None,
    ]
    frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted(map(tuple, tiling.contaminated(docs(spark, texts), frame).collect()))
    assert got == sorted(brute(list(enumerate(texts)), list(enumerate(items))))
    assert [(i, k) for i, k, *_ in got] == [(0, 0), (2, 1), (4, 2), (6, 3), (7, 3), (9, 4), (10, 5)]


def test_a_prompt_that_all_items_share_meets_nothing_by_itself(spark):
    prompt = "answer the following question in one short sentence please"
    items = [f"{prompt} " + " ".join(f"i{k}w{n}" for n in range(20)) for k in range(30)]
    texts = [f"{prompt} {n}" for n in range(30)] + [items[3] + " more", "x " + " ".join(items[7].split()[9:])]
    frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted(map(tuple, tiling.contaminated(docs(spark, texts), frame).collect()))
    assert got == sorted(brute(list(enumerate(texts)), list(enumerate(items)))) and [(i, k) for i, k, *_ in got] == [(30, 3), (31, 7)]
