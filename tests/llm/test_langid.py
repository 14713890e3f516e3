from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scoreloom.llm import langid
from tests.llm.helpers import awkward, docs


def test_query_keeps_and_names_the_documents(spark, sf_dir):
    got = {r.doc_id: r for r in entry.queries()["op8_language_id"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(rows)
    assert np.mean([got[r.doc_id].language == r.lang for r in rows]) > 0.98
    assert np.mean([got[r.doc_id].kept for r in rows]) > 0.98


def test_held_out_accuracy_from_the_text_alone(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    # A fifth of the rows declares nothing, and no host is given.
    hidden = frame.withColumn("said", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    got = langid.identify(hidden, declared="said", host=None).select("row.doc_id", "row.lang", "language").where("doc_id % 5 = 0").collect()
    assert np.mean([r.lang == r.language for r in got]) > 0.95


def test_trigrams_of_rows_stay_apart():
    key, row = langid.trigrams(pa.array(["Ab", None, "", "c!d1", "é"]))
    pack = lambda s: int.from_bytes(s.encode(), "big")
    assert list(zip(key.tolist(), row.tolist())) == [
        (pack(" ab"), 0), (pack("ab "), 0), (pack(" c "), 3), (pack(" d "), 3), (0x20C3A9, 4), (0xC3A920, 4)
    ]


PAGES = "text string, lang string, host string, suffix string"


def pages(spark):
    en, de = "the cat and the dog with this house", "der hund und die katze mit diesem haus"
    rows = [(en, "en", "a.x.com", "com")] * 60 + [(de, "de", "b.y.de", "de")] * 60 + [(en, "de", "c.x.com", "com")] * 3
    rows += [("ok", None, "a.x.com", "com"), ("ok", None, "b.y.de", "de"), ("ok", None, "z.y.de", None), ("ok", None, None, "de"), (de, "en", "a.x.com", "com")]
    return spark.createDataFrame(rows, PAGES)


def test_each_kind_of_evidence_counts(spark):
    got = langid.identify(pages(spark), host="host", suffix="suffix").select("row.*", "language").collect()
    short = {(r.host, r.suffix): r.language for r in got if r.text == "ok"}
    assert short[("a.x.com", "com")] == "en"  # host and suffix
    assert short[("b.y.de", "de")] == "de"
    assert short[(None, "de")] == "de"  # suffix alone
    assert all(r.language == "en" for r in got if r.host == "c.x.com")  # text over a wrong declaration
    assert [r.language for r in got if r.host == "a.x.com" and r.lang == "en" and r.text.startswith("der")] == ["de"]


def test_host_priors_lean_on_the_domain(spark):
    got = langid.identify(pages(spark), host="host").select("row.host", "row.text", "language").where("text = 'ok'").collect()
    assert {r.host: r.language for r in got if r.host in ("a.x.com", "b.y.de")} == {"a.x.com": "en", "b.y.de": "de"}


@pytest.mark.parametrize("clash", ["kept", "text", "_row", "language"])
def test_awkward_rows(spark, clash):
    frame = awkward(spark).withColumnRenamed("n_chars", clash if clash != "text" else "prior")
    got = langid.identify(frame).collect()
    assert len(got) == 10 and sorted(got[0].row.asDict()) == sorted(frame.columns)
    kept = sorted(((r.row.doc_id or -1), r.kept) for r in got if not (r.row.text or "").strip())
    assert kept == [(1, False), (2, False), (3, False)]
    assert langid.identify(docs(spark, [])).count() == 0
    none = langid.identify(docs(spark, ["some text", None])).collect()
    assert [(r.language, r.kept) for r in none] == [(None, False)] * 2


def test_every_page_has_its_four_kinds_of_evidence(spark, sf_dir):
    got = {r.page_id: r for r in entry.queries()["op8_page_language"](spark, sf_dir).collect()}
    read = spark.read.parquet(f"{sf_dir}/pages.parquet")
    seen = {r.page_id: r for r in langid.page_evidence(read).collect()}
    assert set(got) == set(seen) and len(got) == read.count()
    assert all(r.lang and r.text.strip() and r.host.endswith(f".{r.suffix}") for r in seen.values())
    assert np.mean([got[i].language == r.lang for i, r in seen.items()]) > 0.95


def test_evidence_of_awkward_pages(spark):
    rows = [
        ("http://u:p@News.Example.DE:80/x", '<!-- <b>no</b> --><HTML data-lang="xx" class=a LANG=de-AT><style>p{}</style><p>ein&nbsp;Satz <script>var a="</p>"</script>1 < 2'),
        ("//1.2.3.4/x", "<html xml:lang='fr'><!-- open"), ("no address", "<html>"), ("https://[::1]:8/", None), (None, ""), ("ftp://a.co./", "x"),
    ]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    got = [(r.lang, r.host, r.suffix, r.text and " ".join(r.text.split())) for r in langid.page_evidence(frame).orderBy("page_id").collect()]
    assert got == [
        ("de-AT", "news.example.de", "de", "ein Satz 1 < 2"), ("fr", "1.2.3.4", None, ""), (None, None, None, ""), (None, "[::1]", None, None),
        (None, None, None, ""), (None, "a.co", "co", "x"),
    ]


def test_a_host_that_is_its_own_domain_leans_once(spark):
    rows = [("the cat and the dog", "en", "one", None)] * 30 + [("der hund und die katze", "de", "two", None)] * 30
    rows += [("the cat and the dog", "en", "a.x.com", None)] * 30 + [("123", None, h, None) for h in ("one", "b.x.com")]
    got = langid.identify(spark.createDataFrame(rows + [("e", None, "one", None), ("e", None, "b.x.com", None)], PAGES), host="host")
    prior = {(r.host, r.text): r.posterior for r in got.select("row.host", "row.text", "posterior", "language").collect()}
    # Letters aside, (30 + 20 * 61 / 92) / 50 of "one" is English, and so is it of "b.x.com", which has its domain's prior.
    assert prior["one", "e"] == pytest.approx(prior["b.x.com", "e"])
    share = (30 + 20 * 61 / 92) / 50
    model = langid._learn(spark.createDataFrame(rows, PAGES).selectExpr("text", "lang AS declared"), f"{langid.work_path(spark, 'own')}")
    text = model.evidence(pa.array(["e"]))[0][0]
    odds = np.exp(text[1] - text[0]) * share / (1 - share)
    assert prior["one", "e"] == pytest.approx(odds / (1 + odds))


def tongues(spark, n):
    """n languages of three own words each, the later the rarer; one row of each declares nothing."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda i, j: "".join(letters[(i * 7 + j * 11 + s * (1 + i // 26 + j)) % 26] for s in range(6))
    rows = [(" ".join(word(i, j) for j in range(3)), f"t{letters[i // 26]}{letters[i % 26]}") for i in range(n)]
    return spark.createDataFrame([(t, said, i) for t, i in rows for said in [i] * (3 if i > "tc" else 6) + [None]], "text string, lang string, own string")


@pytest.mark.parametrize("most", [None, 0])
def test_more_languages_than_any_bound(spark, monkeypatch, most):
    if most is not None:
        monkeypatch.setattr(langid, "MOST_PAIRS", most)
    got = langid.identify(tongues(spark, 75), host=None).select("row.*", "language", "kept").collect()
    assert len({r.language for r in got}) == 75 and all(r.language == r.own and r.kept for r in got)


def test_pairs_by_a_join_score_the_same(spark, sf_dir, monkeypatch):
    scored = lambda name: sorted((r[0], r.language, round(r.posterior, 9), round(r.fit, 9), r.kept) for r in entry.queries()[name](spark, sf_dir).collect())
    want = scored("op8_page_language")
    monkeypatch.setattr(langid, "MOST_PAIRS", 0)
    monkeypatch.setattr(langid, "CELLS", 40)
    monkeypatch.setattr(langid, "ENTRIES", 50)
    assert scored("op8_page_language") == want


def test_regions_are_no_rivals(spark):
    en, de = "the cat and the dog with this house", "der hund und die katze mit diesem haus"
    rows = [(en, x) for x in ("en", "en-US", " EN_gb ", "en-latn-us")] * 5 + [(de, x) for x in ("de", "de-AT", "")] * 5
    got = langid.identify(spark.createDataFrame(rows, "text string, lang string"), host=None).select("row.*", "language", "posterior").collect()
    assert len(got) == 35 and {(r.text, r.language) for r in got} == {(en, "en"), (de, "de")}
    assert min(r.posterior for r in got) > 0.99


def test_an_unrelated_language_has_no_say_in_its_rivals_odds(spark):
    """Long texts keep their language against a wrong declaration, whatever else the table holds."""
    rng = random.Random(8)
    shared = [f"{a}o{b}e" for a in "bdfgk" for b in "lmnr"]
    kinds = {"aa": shared + ["tsch", "tzun"] * 6, "bb": shared + ["que", "lla"] * 6, "cc": ["字母", "表格", "语言"]}
    text = lambda lang, n: " ".join(rng.choices(kinds[lang], k=n))
    known = [(text(lang, 60), lang) for lang in ("aa", "bb") for _ in range(200)]
    wrong = [(text("aa", 1000), "bb") for _ in range(20)]
    for more in ([], [(text("cc", 60), "cc") for _ in range(200)]):
        rows = [(i, t, lang, None, None) for i, (t, lang) in enumerate(wrong + known + more)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        got = {r.row.doc_id: r.language for r in langid.identify(frame).collect()}
        assert [got[i] for i in range(20)] == ["aa"] * 20
