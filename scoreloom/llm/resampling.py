"""Importance resampling towards a target distribution, over hashed word n-grams.

Words and pairs of consecutive words fall into buckets by CRC-32. The gain of a bucket is the
log ratio of its share in the target to its share in the corpus; a document's weight is the
mean gain of its features, and a share of the documents is drawn without replacement by the
Gumbel top-k method: the highest weights plus noise that a hash of the id gives.

Segment deduplication. A line break is a separator, so it cuts a text without cutting a word.
The corpus' lines are reduced to distinct ones with their occurrences, first in each block of
texts, then by a shuffle; features of a distinct line are counted once and multiplied by
the occurrences. What a line alone does not show, the pair of its last word and the next
line's first one, is a segment of its own kind that holds this pair only. Weights add up
the same way: in a block, a distinct line's gains are summed once.

Bounded: a block holds `BLOCK` bytes of text or one longer text, a line beyond `SEGMENT` bytes is
cut at a separator like a line end, the tables of buckets have `buckets` rows. Ranks come from
a range sort: the place in a range plus the sizes of the ranges before it.

Defined results: null, empty and wordless texts have no features, weight 0 and are never drawn;
a null id hashes as the empty text, ids are ranked nulls last; repeated rows count and are drawn
as often as they stand; with an empty target all gains are smoothed ones; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import packed
from scoreloom.session import work_path

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = 25  # per cent
SEED = "7"
BLOCK = 4 << 20
SEGMENT = 1 << 16
RANGE = 2_000_000  # rows of one range of the final order

#: Bytes of words stay, A-Z in lower case; all others become blanks.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def segments(text: bytes, size: int = SEGMENT):
    """The lines of a text; longer ones in parts cut at a separator."""
    start = 0
    while start < len(text):
        line = text.find(b"\n", start, start + size)
        if line < 0:
            cut = _SEPARATOR.search(text, min(start + size, len(text)))
            line = cut.start() if cut else len(text)
        yield text[start:line]
        start = line + 1


class Block:
    """The distinct lines of some texts, and the pairs of words across lines."""

    def __init__(self, texts):
        lines, pairs, self.words = {}, {}, []
        own_lines, own_pairs = [], []  # of each text, one number an occurrence
        for text in texts:
            mine, across, last = [], [], None
            for line in segments(text):
                number = lines.setdefault(line, len(lines))
                if number == len(self.words):
                    self.words.append(line.translate(_WORDS).split())
                words = self.words[number]
                if words:
                    mine.append(number)
                    if last is not None:
                        across.append(pairs.setdefault((last, words[0]), len(pairs)))
                    last = words[-1]
            own_lines.append(mine)
            own_pairs.append(across)
        self.pairs = list(pairs)
        self.lines, self.line_ends = _flat(own_lines)
        self.across, self.pair_ends = _flat(own_pairs)


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((x for part in lists for x in part), np.int64, int(sizes.sum())), np.cumsum(sizes)


def sums_of(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the ranges that end there."""
    total = np.append(0, np.cumsum(values))
    return np.diff(total[ends], prepend=0)


def _blocks(batches):
    for batch in batches:
        texts = pc.cast(batch.column("text").fill_null(""), pa.binary())
        rows = pa.record_batch([batch.column("doc_id"), texts], ["doc_id", "text"])
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        for part in packed.slices(rows, sizes, BLOCK):
            yield part, Block(t.as_py() for t in part.column("text"))


def _segments(batches):
    """(segment, across, n): distinct lines and pairs of a block, words joined by one space."""
    for _, block in _blocks(batches):
        n = np.bincount(block.lines, minlength=len(block.words))
        some = np.flatnonzero(n)
        crossed = np.bincount(block.across, minlength=len(block.pairs))
        texts = [b" ".join(block.words[i]) for i in some] + [b" ".join(p) for p in block.pairs]
        yield pa.record_batch({
            "segment": pa.array(texts, pa.binary()),
            "across": pa.array(np.arange(len(texts)) >= len(some)),
            "n": pa.array(np.append(n[some], crossed), pa.int64()),
        })


def feature_buckets(words: list[bytes], buckets: int) -> list[int]:
    """Buckets of the words and of the pairs of consecutive words."""
    crc = zlib.crc32
    found = [crc(w) for w in words]
    found += [crc(b, crc(b" ", a)) for a, b in zip(found, words[1:])]
    return [c % buckets for c in found]


def _histogram(buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            across = batch.column("across").to_numpy(zero_copy_only=False)
            found, sizes = [], []
            for segment, pair in zip(batch.column("segment"), across):
                own = [zlib.crc32(segment.as_py()) % buckets] if pair else feature_buckets(segment.as_py().split(b" "), buckets)
                found += own
                sizes.append(len(own))
            each = np.repeat(batch.column("n").to_numpy(), sizes)
            np.add.at(total, np.array(found, np.int64), each)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket, from distinct segments."""
    size = packed.text_size(docs, text)
    rows = docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = rows.mapInArrow(_segments, "segment binary, across boolean, n long")
    dealt = found.repartition(packed.parts(size, 32 << 20), "segment", "across")
    distinct = dealt.groupBy("segment", "across").agg(F.sum("n").alias("n"))
    return distinct.mapInArrow(_histogram(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of each bucket; both inputs have at most `buckets` rows."""
    s, t = ({r.bucket: r.n for r in counts.collect()} for counts in (corpus, target))
    s_all, t_all = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    ratio = (((t.get(b, 0) + 1) * s_all) / ((s.get(b, 0) + 1) * t_all) for b in range(buckets))
    return [math.floor(1000 * math.log(r)) for r in ratio]


def _weights(gain: list[int]):
    def run(batches):
        table = np.array(gain, np.int64)
        for rows, block in _blocks(batches):
            own = [table[feature_buckets(w, len(gain))].sum() if w else 0 for w in block.words]
            own = np.array(own, np.int64)
            words = np.fromiter(map(len, block.words), np.int64, len(block.words))
            pairs = table[[zlib.crc32(b" ".join(p)) % len(gain) for p in block.pairs] or np.zeros(0, np.int64)]
            n_words = sums_of(words[block.lines], block.line_ends)
            total = sums_of(own[block.lines], block.line_ends) + sums_of(pairs[block.across], block.pair_ends)
            n = np.maximum(2 * n_words - 1, 0)
            yield pa.record_batch({
                "doc_id": rows.column("doc_id"),
                "n_words": pa.array(n_words),
                "n_features": pa.array(n),
                "weight": pa.array(total // np.maximum(n, 1)),
            })

    return run


def ranked(rows: DataFrame, order: list, size: int, path: str) -> DataFrame:
    """`rows` with `rank` 1, 2, ... in this order, which no single task sorts."""
    dealt = rows.repartitionByRange(packed.parts(size, RANGE, 1), *order).sortWithinPartitions(*order)
    placed = packed.staged(
        dealt.withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()), path
    )
    # A range's ids count up from its number in the upper bits, in sorted order.
    sizes = placed.groupBy("_range").agg(F.count("*").alias("n"), F.min("_place").alias("least")).orderBy("_range").collect()
    before, at = [], 0
    for r in sizes:
        before.append((r["_range"], at - r["least"] + 1))
        at += r["n"]
    shift = rows.sparkSession.createDataFrame(before, "_range int, shift long")
    return placed.join(F.broadcast(shift), "_range").withColumn("rank", F.col("_place") + F.col("shift")).drop("_range", "_place", "shift")


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    share: int = SHARE, least_words: int = LEAST_WORDS, seed: str = SEED, buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, n_words) of every row; `rank` of the drawn ones only."""
    path = work_path(docs.sparkSession, "resampled")
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets), buckets)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    weighed = rows.mapInArrow(_weights(gain), "doc_id long, n_words long, n_features long, weight long")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = packed.staged(weighed.withColumn("score", F.col("weight") + noise.cast("long")), f"{path}/scored")
    able = F.col("n_words") >= least_words
    n = scored.where(able).count()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    placed = ranked(scored.where(able), order, n, f"{path}/ranked")
    drawn = placed.withColumn("rank", F.when(F.col("rank") <= share * n // 100, F.col("rank")))
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
