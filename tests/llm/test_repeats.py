from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from scoreloom.llm import induced, repeats
from tests.llm.helpers import awkward, docs


def brute(rows, length=repeats.LENGTH):
    """rows: (id, text); every window of every text counted."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(hash(t[k : k + length]) for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        covered = np.zeros(len(t) + 1, int)
        for k in range(len(t) - length + 1):
            if seen[hash(t[k : k + length])] > 1:
                covered[k] += 1
                covered[k + length] -= 1 if k + length <= len(t) else 0
        mask = np.cumsum(covered)[: len(t)] > 0
        spans = int((mask & ~np.append(False, mask[:-1])).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~mask])
        out.append((i, len(t), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(frame):
    return [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in frame.collect()]


def key(row):
    return tuple(-1 if x is None else x for x in row)


def test_query_equals_brute_force(spark, sf_dir):
    got = entry.queries()["op7_induced_dedup"](spark, sf_dir).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, got)) == sorted(brute(rows))
    assert sum(r.n_removed for r in got) > 0


def passages(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [text(n) for n in (150, 199, 200, 201, 260, 500, 1200)]
    rows = []
    for _ in range(60):
        parts = [text(rng.randrange(0, 300))]
        for _ in range(rng.randrange(0, 4)):
            s = rng.choice(shared)
            cut = rng.randrange(0, 60)
            parts += [s[cut:] if rng.random() < 0.4 else s, text(rng.randrange(0, 120))]
        rows.append("".join(parts))
    return rows + ["x" * 1000, "xy" * 400, "y" + "x" * 250, "abcdefg" * 60, rows[3], rows[3], None, "", "é" * 100, "é" * 101]


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_passages_and_periodic_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 4000)
    texts = passages(hot)
    got = result(repeats.remove_repeats(docs(spark, texts).repartition(5)))
    assert sorted(got) == sorted(brute(list(enumerate(texts))))


@pytest.mark.parametrize("part", [1, 37, 300, 1 << 18])
def test_runs_of_parts_hold_every_window_once(part):
    """However the windows are dealt over parts, each is in one run, and equal ones have one anchor."""
    texts = [t.encode() for t in passages(5) if t]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    starts, sizes, grams, _ = repeats.runs_of(data, offsets, part=part)
    windows = [w for s, n in zip(starts.tolist(), sizes.tolist()) for w in range(s, s + n)]
    want = [o + k for o, t in zip(offsets.tolist(), texts) for k in range(len(t) - repeats.LENGTH + 1)]
    assert windows == want
    anchor, flat = {}, data.tobytes()
    for w, g in zip(windows, np.repeat(grams, sizes).tolist()):
        assert anchor.setdefault(flat[w : w + repeats.LENGTH], g) == g


def test_awkward_rows(spark):
    frame = awkward(spark).withColumnRenamed("lang", "block").withColumnRenamed("source", "kept")
    got = result(repeats.remove_repeats(frame))
    assert sorted(got, key=key) == sorted(brute([(r.doc_id, r.text) for r in frame.collect()]), key=key)
    assert repeats.remove_repeats(docs(spark, [])).count() == 0


@pytest.mark.parametrize("memory", [64, 1 << 20])
def test_induced_sorting_against_counting(memory):
    rng = random.Random(memory)
    for _ in range(200):
        length, symbols = rng.choice([2, 3, 5, 8, 17]), rng.choice([1, 2, 3, 20])
        strings = []
        for _ in range(rng.randrange(1, 8)):
            s = [rng.randrange(1, symbols + 1) for _ in range(rng.randrange(0, 40))]
            if strings and rng.random() < 0.5:
                s = list(rng.choice(strings))[rng.randrange(5) :]
            strings.append(s)
        flat = [x for s in strings for x in [*s, 0]]
        text = bytes(flat)
        seen = Counter(text[i : i + length] for i in range(len(text)))
        got = induced.repeated_starts(np.array(flat, np.uint8), length, memory)
        for i in range(len(text)):
            if text.find(b"\0", i) - i >= length:
                assert got[i] == (seen[text[i : i + length]] > 1)
