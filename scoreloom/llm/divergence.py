"""Audit of how sources of one language differ in their words.

Every language keeps the terms that stand in at least `least_docs` of its documents. A (lang,
source) group and a language give each kept term a smoothed share in billionths. Two reports:
the summed distance of shares between the sources of a language, and the terms that a
source uses more than its language does, the `top` largest differences of each group.

Dominance skyband. The difference of a term grows with its count in the group and falls
with its count in the language, and ties go to the earlier UTF-8 bytes. So a term that has
`top` others with no smaller group count, no larger language count and earlier bytes cannot
be among the `top`. Each partition holds a part of a group's terms, by hash of the term, and
retains those dominated by fewer than `top` terms in it; the retained ones of a group meet,
are thinned in the same way, and only the rest is ranked by exact differences. A term's
dominators are counted among retained terms only: those are enough, as dominance is transitive.

Plan. A block of texts counts its distinct (group, term) pairs; sums are taken by Spark with
map-side aggregation, so that hot groups and words shrink before the shuffle. Distances come
from chunks of terms and blocks of at most `SOURCES` sources: a chunk adds up what all pairs of
its sources differ in, so memory is bounded and no pair of rows is emitted before its sum.

Arithmetic is exact: shares are quotients of 38-digit decimals, sums are integers.

Defined results: null text, lang and source are empty; groups without a kept term have all
shares alike (or no terms at all: distance 0); repeated rows are documents of their own; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm import packed
from scoreloom.session import work_path

LEAST_DOCS = 30
TOP = 50
BLOCK = 8 << 20  # bytes of text in which terms are counted together
SOURCES = 256  # sources of a block of the distance report
CHUNK = 1_000  # terms of a chunk of it
STEP = 256  # terms that the skyband compares at a time
_GROUP = ["lang", "source"]

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every term."""
    inside = _INSIDE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # a row starts anew, also behind a letter
    starts = np.flatnonzero(inside & (first[:-1] | ~np.append(False, inside[:-1])[: len(data)]))
    ends = np.flatnonzero(inside & (first[1:] | ~np.append(inside[1:], False)[: len(data)])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _counted(batches):
    """(lang, source, term, n, docs) of the distinct pairs of group and term of each block."""
    for batch in batches:
        lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
        for rows in packed.slices(batch, lengths, BLOCK):
            data, offsets = packed.text_bytes(rows.column("text"))
            starts, ends, row = _bounds(data, offsets)
            if not len(starts):
                continue
            sizes = ends - starts
            flat = _LOWER[data[packed.ragged(starts, sizes)]]
            cuts = np.append(0, np.cumsum(sizes))
            terms = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(sizes), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(flat)]
            ).dictionary_encode()
            names, term = terms.dictionary, terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            keys = pa.StructArray.from_arrays([rows.column("lang"), rows.column("source")], _GROUP)
            pairs = [f"{len(k['lang'])}:{k['lang']}{k['source']}" for k in keys.to_pylist()]
            _, example, group = np.unique(np.array(pairs, object), return_index=True, return_inverse=True)
            per_doc, count = np.unique(row * len(names) + term, return_counts=True)
            pair = group[per_doc // len(names)] * len(names) + per_doc % len(names)
            found, place = np.unique(pair, return_inverse=True)
            n = np.zeros(len(found), np.int64)
            np.add.at(n, place, count)
            of = pa.array(example[found // len(names)])
            yield pa.record_batch({
                "lang": rows.column("lang").take(of),
                "source": rows.column("source").take(of),
                "term": names.take(pa.array(found % len(names))).cast(pa.large_string()).cast(pa.string()),
                "n": pa.array(n),
                "docs": pa.array(np.bincount(place), pa.int64()),
            })


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of every group."""
    named = [F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((text, "text"), (lang, "lang"), (source, "source"))]
    found = docs.select(*named).mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """Smoothed share in billionths; at least 1."""
    wide = lambda c: c.cast("decimal(19,0)")
    above = (wide(count) + 5) * F.lit(1_000_000_000).cast("decimal(10,0)")
    below = wide(total) + wide(terms) * 5
    return 1 + F.call_function("div", above, below).cast("long")


def skyband(first: np.ndarray, second: np.ndarray, third: np.ndarray, k: int) -> np.ndarray:
    """Rows dominated by fewer than k others: larger `first`, smaller `second`, smaller `third`.

    `third` has no two equal values. Rows come in an order that puts dominators first, so
    one walk suffices; it compares a step of rows with what is retained and with itself.
    """
    order = np.lexsort((third, second, -first))
    kept = np.zeros(0, np.int64)
    for at in range(0, len(order), STEP):
        step = order[at : at + STEP]
        over = (second[kept] <= second[step, None]) & (third[kept] <= third[step, None])
        own = (second[step] <= second[step, None]) & (third[step] <= third[step, None])
        dominators = over.sum(1) + np.tril(own, -1).sum(1)
        kept = np.append(kept, step[dominators < k])
    return np.sort(kept)


def _retained(k: int):
    """Thins groups that come one after another; the last one of a batch waits for its rest."""

    def thin(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        n, total = rows.column("n").to_numpy(), rows.column("total").to_numpy()
        rank = np.empty(len(n), np.int64)
        rank[pc.sort_indices(rows.column("term").cast(pa.binary())).to_numpy()] = np.arange(len(n))
        return rows.take(pa.array(skyband(n, total, rank, k)))

    def run(batches):
        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            if not part.num_rows:
                continue
            names = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
            keys = np.array([f"{len(a)}:{a}{b}" for a, b in names], object)
            cuts = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))
            for a, b in zip(cuts, cuts[1:]):
                own = part.slice(a, b - a)
                if held is not None and held[0] == keys[a]:
                    own = pa.concat_tables([held[1], own])
                elif held is not None:
                    yield from held[1].to_batches()
                held = keys[a], thin(own)
        if held is not None:
            yield from held[1].to_batches()

    return run


def distinctive_terms(kept: DataFrame, top: int = TOP, parts: int | None = None) -> DataFrame:
    """The `top` terms of each group by p - q, exactly, from (lang, source, term, n, total, p, q)."""
    columns = ["lang", "source", "term", "n", "total", "p", "q"]
    schema = "lang string, source string, term string, n long, total long, p long, q long"
    more = kept.where("p > q").select(*columns)
    local = more.repartition(parts, "lang", "term") if parts else more.repartition("lang", "term")
    local = local.sortWithinPartitions(*_GROUP).mapInArrow(_retained(top), schema)
    merged = local.repartition(parts, *_GROUP) if parts else local.repartition(*_GROUP)
    merged = merged.sortWithinPartitions(*_GROUP).mapInArrow(_retained(top), schema)
    best = Window.partitionBy(*_GROUP).orderBy(F.col("value").desc(), "item")
    found = merged.select(*_GROUP, F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def _distances(width: int):
    """Sums of |p - p'| over the terms of one chunk that some source of two blocks has, and their number."""

    def run(key, sources: pa.Table, cells: pa.Table) -> pa.Table:
        lang, chunk, low, high = (k.as_py() for k in key)
        numbers = sources.column("number").to_numpy()
        order = np.argsort(numbers)
        numbers, none = numbers[order], sources.column("none").to_numpy()[order]
        terms = cells.column("term").dictionary_encode().combine_chunks()
        term = terms.indices.to_numpy(zero_copy_only=False) if cells.num_rows else np.zeros(0, np.int64)
        count = len(terms.dictionary) if cells.num_rows else 0
        share_of = np.repeat(none[:, None], count, 1)
        share_of[np.searchsorted(numbers, cells.column("number").to_numpy()), term] = cells.column("p").to_numpy()
        first, second = np.flatnonzero(numbers // width == low), np.flatnonzero(numbers // width == high)
        sums = np.array([np.abs(share_of[second] - share_of[i]).sum(1) for i in first], np.int64).reshape(len(first), -1)
        a, b = np.repeat(numbers[first], len(second)), np.tile(numbers[second], len(first))
        keep = a < b
        n = int(keep.sum())
        return pa.table({
            "lang": pa.array([lang] * n, pa.string()), "a": pa.array(a[keep], pa.int64()),
            "b": pa.array(b[keep], pa.int64()), "value": pa.array(sums.reshape(-1)[keep], pa.int64()),
            "seen": pa.array([count] * n, pa.int64()),
        })

    return run


def source_distances(kept: DataFrame, groups: DataFrame, languages: DataFrame) -> DataFrame:
    """Distance of every two sources of a language, both ways, with ranks.

    `kept` has a row (lang, source, term, p) for each term of a group, `groups` a row (lang,
    source, number, none) for each group, where `none` is the share of a term it lacks and numbers
    count from 0 in a language, and `languages` a row (lang, terms, chunks, blocks).
    """
    spread = groups.join(languages, "lang").withColumn("block", F.floor(F.col("number") / SOURCES))
    beside = spread.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    # A block of sources meets each other block once, and itself.
    beside = beside.select(
        "lang", "source", "number", "none", "chunks", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    keys = ["lang", "chunk", "low", "high"]
    chunked = beside.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    cells = kept.select(*_GROUP, "term", "p").join(beside.select(*_GROUP, "number", "low", "high", "chunks"), _GROUP)
    cells = cells.withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")))
    cells = cells.select(*(F.col(c).alias(c) for c in [*keys, "number", "term", "p"]))  # columns of their own for the cogroup
    found = (
        chunked.select(*keys, "number", "none").groupBy(*keys)
        .cogroup(cells.groupBy(*keys))
        .applyInArrow(_distances(SOURCES), "lang string, a long, b long, value long, seen long")
    )
    sums = found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value", "seen"))
    named = both.join(groups.select("lang", F.col("number").alias("a"), "source", F.col("none").alias("none_a")), ["lang", "a"])
    other = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"), F.col("none").alias("none_b"))
    named = named.join(other, ["lang", "b"]).join(languages.select("lang", "terms"), "lang")
    # Terms that no source of the two blocks has differ like the shares of a lacking term.
    unseen = (F.col("terms") - F.col("seen")) * F.abs(F.col("none_a") - F.col("none_b"))
    named = named.withColumn("value", F.col("value") + unseen)
    best = Window.partitionBy(*_GROUP).orderBy(F.col("value").desc(), "item")
    return named.select("lang", "source", "item", "value").withColumn("rank", F.row_number().over(best))


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least_docs: int = LEAST_DOCS, top: int = TOP,
) -> DataFrame:
    """(lang, source, part, item, value, rank): parts `pair` and `term` of every group."""
    path = work_path(docs.sparkSession, "divergence")
    counts = packed.staged(term_counts(docs, text, lang, source), f"{path}/counts")
    totals = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    totals = totals.where(F.col("docs") >= least_docs).drop("docs")
    kept = packed.staged(counts.join(totals, ["lang", "term"]).drop("docs"), f"{path}/kept")

    numbered = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source")))).distinct()
    in_group = kept.groupBy(*_GROUP).agg(F.sum("n").alias("group_n"))
    in_lang = kept.select("lang", "term", "total").distinct().groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("total").alias("lang_n")
    )
    groups = groups.join(in_group, _GROUP, "left").join(in_lang, "lang", "left")
    groups = groups.fillna(0, ["group_n", "terms", "lang_n"]).withColumn("number", numbered.cast("long"))
    zero = F.lit(0).cast("long")
    none = F.when(F.col("terms") > 0, share(zero, F.col("group_n"), F.col("terms"))).otherwise(zero)
    groups = packed.staged(groups.withColumn("none", none), f"{path}/groups")
    languages = groups.groupBy("lang").agg(F.max("terms").alias("terms"), F.max("number").alias("last")).select(
        "lang", "terms", F.ceil(F.greatest("terms", F.lit(1)) / CHUNK).alias("chunks"), (F.floor(F.col("last") / SOURCES) + 1).alias("blocks")
    )
    shares = kept.join(groups.select(*_GROUP, "group_n", "terms", "lang_n"), _GROUP).select(
        *_GROUP, "term", "n", "total",
        share(F.col("n"), F.col("group_n"), F.col("terms")).alias("p"),
        share(F.col("total"), F.col("lang_n"), F.col("terms")).alias("q"),
    )
    pair = source_distances(shares, groups.select(*_GROUP, "number", "none"), languages).withColumn("part", F.lit("pair"))
    term = distinctive_terms(shares, top).withColumn("part", F.lit("term"))
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", "rank")
