from __future__ import annotations

import random

import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from scoreloom.llm import bpe, repeats
from scoreloom.llm.text_queries import PATTERN, RANKS
from tests.llm import test_jaccard, test_tiling
from tests.llm.helpers import DOCS, awkward


def cut(rows):
    """Brute-force removal of repeated strings, character by character: no decoding with replacement."""
    from collections import Counter

    length = repeats.LENGTH
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = {}
    for i, t in texts:
        drop = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                drop[k : k + length] = b"\1" * length
        left, at = [], 0
        for c in t.decode():
            n = len(c.encode())
            if not any(drop[at : at + n]):
                left.append(c)
            at += n
        out[i] = "".join(left)
    return out


def test_run_equals_brute_force(spark, sf_dir):
    got = {r.doc_id: r for r in entry.queries()["pipeline"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = {r.doc_id for r in pipeline.language(spark, docs, sf_dir).select("doc_id").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in known]
    assert len(rows) > 0.98 * docs.count()
    rows = [(i, t) for (i, t), (_, _, c) in zip(rows, test_jaccard.brute(rows)) if i == c]
    rows = sorted(cut(rows).items())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {i for i, *_ in test_tiling.brute(rows, items)}
    want = {i: t for i, t in rows if i not in leaks}
    assert leaks and set(got) == set(want)
    coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    assert all(got[i].ids == coder.encode_ordinary(t) and got[i].n_tokens == len(got[i].ids) for i, t in want.items())


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, sf_dir, stage):
    frame = awkward(spark).withColumn("lang", F.lit("en"))
    assert stage(spark, frame.limit(0), sf_dir).count() == 0
    out = stage(spark, frame, sf_dir)
    if stage is not pipeline.encode:
        assert out.columns == pipeline.COLUMNS
    if stage is pipeline.language:  # blank texts go; in a table this small, so does what is unlike the rest
        assert {4, 5} <= {r.doc_id for r in out.collect()} and not out.where("trim(coalesce(text, '')) = ''").count()
    elif stage is pipeline.near_duplicates:  # brute force over row numbers; blank texts are classes of their own
        rows = frame.collect()
        classes = {c for *_, c in test_jaccard.brute([(n, r.text) for n, r in enumerate(rows)])}
        assert out.count() == len(classes) == 7
    else:
        assert out.count() == 10


def test_rows_without_an_id_and_ids_of_two_texts(spark, sf_dir):
    words = " ".join(f"own{i}" for i in range(60))
    item = next(r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect())
    texts = [(None, words), (None, words + " end"), (5, words.upper()), (7, "one text of seven words is here"), (7, "another text that is not at all like it"), (None, item), (9, "clean")]
    frame = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in texts], DOCS)
    left = pipeline.near_duplicates(spark, frame, sf_dir).collect()
    assert sorted((str(r.doc_id), r.text) for r in left) == sorted((str(i), t) for i, t in texts[2:])
    left = pipeline.decontaminate(spark, frame, sf_dir).collect()
    assert sorted((str(r.doc_id), r.text) for r in left) == sorted((str(i), t) for i, t in texts if t != item)


def test_repeats_touch_no_other_character(spark, sf_dir):
    """Genuine U+FFFD stay, and halves of two cut characters never make a third one."""
    shared = "".join(chr(97 + i * i % 26) for i in range(230))
    begin, end = b"\xa9" + shared.encode(), shared[:229].encode() + b"\xc3"  # a second byte, a first byte
    halves = [b"z \xc3" + begin + b" x", b"q \xc4" + begin + b" y", b"k " + end + b"\xa3 w", b"l " + end + b"\xa4 v"]
    texts = [t.decode() for t in halves] + [f"start \ufffd {shared}\ufffd tail \ufffd", "\ufffd" * 70, "\ufffd" * 70, "clean \ufffd"]
    frame = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS)
    out = {r.doc_id: r for r in pipeline.remove_repeats(spark, frame, sf_dir).collect()}
    want = cut(list(enumerate(texts)))
    assert {i: r.text for i, r in out.items()} == want and all(r.n_chars == len(r.text) for r in out.values())
    assert want[4].count("\ufffd") == 3 and want[7] == "clean \ufffd" and want[5] == ""


def test_near_duplicates_keep_one_of_each_class(spark, sf_dir):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join(test_jaccard.edited(rng, base, 1)) for _ in range(6)] + ["own words of another text"] * 2 + [None, ""]
    frame = spark.createDataFrame([(10 + i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS)
    left = pipeline.near_duplicates(spark, frame, sf_dir).select("doc_id").collect()
    assert sorted(r.doc_id for r in left) == [10, 16, 18, 19]
