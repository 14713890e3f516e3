"""Quality rules: a threshold table compiled into one projection.

A rule is one line of a table (metric, lowest, highest). `quality_columns` compiles the
table into column expressions over the text: lengths, symbol, stop-word, line and
repetition ratios, and the verdict. There is no user function, no shuffle and no join:
a row's verdict depends on that row alone, so hot sources and copies cost nothing extra.

Defined results:

* null text counts as the empty text: all counts 0, `base_failed` true, `kept` false;
* ratios with a zero denominator are 0.0, so only count rules can fail an empty text;
* repeated rows each get their own verdict; further columns of the input are untouched
  (metrics come in one struct, so their names cannot clash with the input's).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

#: Frequent function words, for "is there running prose at all".
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "on", "with", "as"],
    "de": ["der", "die", "das", "und", "in", "den", "von", "zu", "mit", "sich", "ist", "nicht"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "est", "que", "dans"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "las", "un", "por", "con"],
}


class Rule(NamedTuple):
    """`metric` must lie within [lowest, highest]; None leaves a side open."""

    name: str
    metric: str
    lowest: float | None
    highest: float | None


RULES = (
    Rule("words", "n_words", 50, None),
    Rule("repeated_words", "repeat_ratio", None, 0.5),
    Rule("word_length", "mean_word_chars", 2.0, 20.0),
    Rule("symbols", "symbol_ratio", None, 0.3),
    Rule("alphabetic", "alpha_ratio", 0.6, None),
    Rule("stop_words", "n_stop_words", 2, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.5),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.9),
)
#: The rules whose failure is reported as `base_failed`.
BASE_RULES = ("words", "repeated_words")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _covered(positions: Column) -> Column:
    """How many places the windows starting at these ascending positions cover."""
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    step = lambda acc, p: F.struct(
        (acc["total"] + p + WINDOW - F.greatest(p, acc["end"])).alias("total"), (p + WINDOW).alias("end")
    )
    return F.aggregate(positions, start, step, lambda acc: acc["total"])


def with_metrics(docs: DataFrame, text: str = "text", into: str = "metrics") -> DataFrame:
    """Adds a struct of all metrics of `text` to each row, all other columns kept."""
    t, w, k, lines = F.col("_text"), F.col("_words"), F.col("_windows"), F.col("_lines")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if docs.columns else F.struct(F.lit(1))
    step = docs.select(own.alias("_row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    step = step.select(
        "_row",
        "_text",
        F.filter(F.split(t, SPACES), lambda x: x != "").alias("_words"),
        F.filter(F.split(t, "\n"), lambda x: F.translate(x, " \t\n\x0b\x0c\r", "") != "").alias("_lines"),
    )
    # Windows of three words by hash and place: sorting brings equal ones together.
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.struct(
            F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]).alias("h"), i.alias("i")
        ),
    )
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    step = step.select(
        "_row", "_text", "_words", "_lines",
        F.when(F.size(w) >= WINDOW, F.sort_array(hashed)).otherwise(empty).alias("_windows"),
    )
    same = lambda a, b: (a["h"] == b["h"]) & F.coalesce(  # noqa: E731  the words decide, not the hash
        F.slice(w, a["i"] + 1, WINDOW) == F.slice(w, b["i"] + 1, WINDOW), F.lit(False)
    )
    twice = F.filter(
        k, lambda x, j: F.coalesce(same(x, F.get(k, j - 1)), F.lit(False)) | F.coalesce(same(x, F.get(k, j + 1)), F.lit(False))
    )
    step = step.select(
        "_row", "_text", "_words", "_lines",
        F.sort_array(F.transform(twice, lambda x: x["i"])).alias("_repeats"),
    )
    stop = sorted({x for words in STOP_WORDS.values() for x in words})
    n, n_lines = F.size(w), F.size(lines)
    counts = step.select(
        "_row",
        n.cast("long").alias("n_words"),
        F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _covered(F.col("_repeats")).cast("long").alias("n_repeat_words"),
        n_lines.cast("long").alias("n_lines"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(stop))).cast("long").alias("n_stop_words"),
        F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))).cast("long").alias("n_alpha_words"),
        F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")))
        .cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter(lines, lambda x: F.ltrim(x).rlike(r"^[-*•]"))).cast("long").alias("n_bullet_lines"),
    )
    ratios = {
        "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
        "symbol_ratio": _ratio(F.col("n_symbols"), F.col("n_words")),
        "repeat_ratio": _ratio(F.col("n_repeat_words"), F.col("n_words")),
        "alpha_ratio": _ratio(F.col("n_alpha_words"), F.col("n_words")),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
        "ellipsis_line_ratio": _ratio(F.col("n_ellipsis_lines"), F.col("n_lines")),
        "bullet_line_ratio": _ratio(F.col("n_bullet_lines"), F.col("n_lines")),
    }
    names = [c for c in counts.columns if c != "_row"]
    metrics = F.struct(*[F.col(c) for c in names], *[v.alias(c) for c, v in ratios.items()])
    return counts.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c != into], metrics.alias(into))


def broken(rules=RULES, metrics: str = "metrics") -> Column:
    """The names of the rules that a row breaks, in the order of the table."""
    tests = []
    for rule in rules:
        value = F.col(metrics)[rule.metric]
        low = value < rule.lowest if rule.lowest is not None else F.lit(False)
        high = value > rule.highest if rule.highest is not None else F.lit(False)
        tests.append(F.when(low | high, F.lit(rule.name)))
    return F.array_compact(F.array(*tests))


def apply_rules(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """Each row with `metrics`, the names of the `broken` rules, and `kept`."""
    measured = with_metrics(docs, text).withColumn("broken", broken(rules))
    return measured.withColumn("kept", F.size("broken") == 0)
