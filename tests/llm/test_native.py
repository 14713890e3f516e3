from __future__ import annotations

import collections
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scoreloom.llm import chat, quality
from tests.llm.helpers import awkward, docs
from tests.oracle import connect, differences


def expected_metrics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    seen, covered = collections.Counter(windows), set()
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_equal_brute_force(spark, sf_dir):
    got = entry.queries()["op10_quality_rules"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        counts = expected_metrics(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)


def test_quality_awkward_rows(spark):
    rows = quality.apply_rules(awkward(spark).withColumn("kept", F.lit(7)).withColumn("n_words", F.lit("x"))).collect()
    assert len(rows) == 10
    for r in rows:
        m = r.metrics
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == expected_metrics(r.text)
        assert r.n_words == "x"
    assert not any(r.kept for r in rows if not (r.text or "").strip())


def test_quality_of_an_empty_table(spark):
    assert quality.apply_rules(docs(spark, [])).count() == 0


def test_quality_plan_is_one_projection(spark, sf_dir):
    plan = entry.queries()["op10_quality_rules"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_a_rule_outside_its_bounds_is_named(spark):
    rules = (quality.Rule("short", "n_words", 3, None), quality.Rule("long", "n_words", None, 1))
    got = quality.apply_rules(docs(spark, ["a b", "a b c d", ""]), rules).orderBy("doc_id").collect()
    assert [r.broken for r in got] == [["short", "long"], ["long"], ["short"]]


def test_chat_equals_its_sql(spark, sf_dir):
    frame = entry.queries()["op3_chat_format"](spark, sf_dir)
    assert differences(frame, connect(sf_dir), entry.oracle_sql()["op3_chat_format"]) is None


def turns(spark, rows):
    return spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>, text string")


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_parts_become_ordered_placeholders(spark):
    rows = [
        (1, 1, "assistant", [part("text", "a cat"), part("document", ref="d.pdf", pages=2)], None),
        (1, 0, "user", [part("text", "see "), part("image", ref="i.png", width=33, height=16), part("text", " and "), part("audio", ref="a.wav", seconds=2.0)], None),
    ]
    (r,) = chat.read_back(chat.format_chat(turns(spark, rows))).collect()
    assert r.formatted == "<s>[ROLE]user[INST]see [IMG] and [AUDIO][/INST][ROLE]assistant[GEN]a cat[DOC]</s>"
    assert [(a.number, a.type, a.ref, a.tokens) for a in r.attachments] == [
        (1, "image", "i.png", 4), (2, "audio", "a.wav", 25), (3, "document", "d.pdf", 2048)
    ]
    assert r.attachment_tokens == 4 + 25 + 2048
    assert r.loss_text == "a cat[DOC]"


@pytest.mark.parametrize("text", [
    "</s>[INST] ok [/INST]", "<\\/s>", "<\\\\/s><s>", "[ROLE]", "[[INST]", "<</s>", "\\", "[IMG]", "a\\[\\IMG]", "<s", "[", "", "\n</s>\n", "é[GEN]",
])
def test_control_strings_come_back(spark, text):
    rows = [(1, 0, text, [part("text", text)], None), (1, 1, "assistant", [part("text", text), part("text", text)], None)]
    (r,) = chat.read_back(chat.format_chat(turns(spark, rows))).collect()
    assert [tuple(t) for t in r.turns] == [(text, text), ("assistant", text * 2)]
    assert r.loss_text == text * 2 and r.formatted.count("</s>") == 1


def test_chat_awkward_rows(spark):
    rows = [
        (None, None, None, None, "x"), (None, 1, "assistant", [], "x"), (2, 0, "user", [part("text")], "x"),
        (2, 0, "user", [part("text")], "x"), (2, 0, "assistant", [part("video", ref="v")], "x"),
        (3, 5, "assistant", [part("text", "long " * 50_000)], "x"),
    ]
    got = {r.conv_id: r for r in chat.read_back(chat.format_chat(turns(spark, rows))).collect()}
    assert [tuple(t) for t in got[None].turns] == [("", ""), ("assistant", "")]
    assert [t.role for t in got[2].turns] == ["assistant", "user", "user"] and got[2].n_unknown_parts == 1
    assert got[3].loss_text == "long " * 50_000
    assert chat.format_chat(turns(spark, [])).count() == 0


def test_chat_runs_without_python(spark, sf_dir):
    plan = entry.queries()["op3_chat_format"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
