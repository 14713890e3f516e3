"""Benchmark decontamination by greedy string tiling (running Karp-Rabin).

A document and a benchmark item are compared by tiles: longest common token strings that
do not overlap on either side, marked greedily, longest first (Wise: "Running Karp-Rabin
matching and greedy string tiling", 1993). Tiles may stand in any order, so an item that
was rearranged sentence by sentence is still covered. A document that covers at least
`threshold` of an item's tokens, by tiles of `least` tokens or more, is contaminated.

Plan. Every window of `least` tokens of the items is a seed. Documents are cut into blocks;
the hashes of a block's windows are taken at once, and only windows whose hash is a
seed leave the task. The seeds reach the tasks in one of two ways, by their measured number:
up to `BROADCAST_SEEDS` as a sorted array of at most that many numbers in the task's closure,
beyond that through a shuffle of the blocks' distinct window hashes against the seeds'. Tiles
consist of seeds, so a pair at the threshold shares one of the item's rare seeds: those left
when the seeds that most items hold are set aside, as long as these cover less than the threshold.
Pairs meet by rare seeds only, so a prompt that all items begin with joins nothing. Pairs
whose seeds cover too little of the item are dropped by an exact bound; for the others item
and document meet in one row and are tiled. A pair is a row
of its own, so a passage that a third of all documents share is spread over tasks.

Tokens are runs of letters and digits, A-Z lower-cased; characters of scripts written without
spaces (`SINGLE`) are tokens of their own, and punctuation of any script (`PARTING`) parts tokens.

An item of fewer than `least` tokens is one seed, its whole sequence, found anywhere in a text; of
fewer than `shortest`, which stand in many texts by chance, it is found where it is the whole text.

Defined results: null and empty texts match nothing, nor do items without tokens; repeated rows
return repeated pairs; null ids are returned like other ids; other columns are left out.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm import packed
from scoreloom.session import work_path

LEAST, SHORTEST, THRESHOLD = 5, 3, 0.5
BLOCK_BYTES = 3 << 20
BROADCAST_SEEDS = 2_000_000
_U = np.uint64
_ODD = _U(0xD1342543DE82EF95)

# Ranges of code points.
SINGLE = [  # Thai and Lao, Burmese, Khmer, ideographic marks, kana, Han, halfwidth kana, Han supplements
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3041, 0x30FA), (0x30FC, 0x30FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF),
]
PARTING = [  # Latin-1 signs, Arabic and Indic stops, general punctuation without joiners, CJK and fullwidth punctuation
    (0x0080, 0x00A9), (0x00AB, 0x00B4), (0x00B6, 0x00B9), (0x00BB, 0x00BF), (0x00D7, 0x00D7), (0x00F7, 0x00F7),
    (0x060C, 0x060C), (0x061B, 0x061B), (0x061F, 0x061F), (0x06D4, 0x06D4), (0x0964, 0x0965), (0x1680, 0x1680),
    (0x2000, 0x200B), (0x200E, 0x206F), (0x3000, 0x3004), (0x3008, 0x3020), (0x3030, 0x3030), (0x303D, 0x303F),
    (0x30FB, 0x30FB), (0xFE10, 0xFE1F), (0xFE30, 0xFE6F), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40),
    (0xFF5B, 0xFF65),
]

# Of ASCII, everything but letters and digits parts tokens.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[[*range(48, 58), *range(97, 123)]] = [*range(48, 58), *range(97, 123)]
_FOLD[65:91] = np.arange(97, 123)


def _within(codes: np.ndarray, ranges: list[tuple[int, int]]) -> np.ndarray:
    edges = np.array([x for low, high in ranges for x in (low, high + 1)])
    return np.searchsorted(edges, codes, "right") % 2 == 1


def _wide(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and code point of the characters beyond ASCII."""
    at = np.flatnonzero(data >= 0xC0)
    size = 2 + (data[at] >= 0xE0) + (data[at] >= 0xF0)
    code = data[at].astype(np.int64) & np.array([0, 0, 0x1F, 0x0F, 0x07])[size]
    for j in range(1, 4):
        use = size > j
        code[use] = code[use] << 6 | data[at[use] + j] & 0x3F
    return at, at + size, code


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes, and the token ranges of the rows (one more at the end)."""
    data, offsets = packed.text_bytes(column)
    first, last, code = _wide(data)
    data = _FOLD[data]
    part = _within(code, PARTING)
    data[packed.ragged(first[part], last[part] - first[part])] = 0x20
    starts, ends, row = packed.word_bounds(data, offsets)
    alone = _within(code, SINGLE)
    if alone.any():
        first, last = first[alone], last[alone]
        begin, finish = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        begin[starts] = begin[first] = finish[ends] = finish[last] = True
        text = data != 0x20
        begin[last[last < len(data)]] |= text[last[last < len(data)]]
        finish[first[first > 0]] |= text[first[first > 0] - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(finish)
        row = np.searchsorted(offsets, starts, "right") - 1
    return packed.span_hash(packed.byte_sums(data), starts, ends), np.searchsorted(row, np.arange(len(offsets)))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of so many tokens."""
    n = max(0, len(hashes) - width + 1)
    with np.errstate(over="ignore"):
        out = np.full(n, _U(width))
        for j in range(width):
            out = packed.mix(out * _ODD + hashes[j : j + n])
    return out


def _free(sums: tuple[np.ndarray, np.ndarray], free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows of `size` tokens none of which is marked."""
    taken = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(taken[size:] == taken[: len(taken) - size])
    return at, packed.span_hash(sums, at, at + size)


def tile(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in a, place in b, length), longest first.

    The search length starts at the whole of the shorter string. It falls to the longest at
    which an unmarked window of b has the rolling hash of one of a, which is found by halving, as a
    common string has all shorter ones in it; the matches of that length are compared token by token
    and marked, and the search goes on below it.
    """
    sums = packed.value_sums(packed.mix(a)), packed.value_sums(packed.mix(b))
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    tiles, size = [], min(len(a), len(b))
    while size >= least:
        low, high = least - 1, size
        while low < high:
            middle = (low + high + 1) // 2
            if np.isin(_free(sums[0], free_a, middle)[1], _free(sums[1], free_b, middle)[1]).any():
                low = middle
            else:
                high = middle - 1
        size = low
        if size < least:
            break
        (at_a, key_a), (at_b, key_b) = _free(sums[0], free_a, size), _free(sums[1], free_b, size)
        both = np.isin(key_b, key_a)
        table = defaultdict(list)
        for i, h in zip(at_a.tolist(), key_a.tolist()):
            table[h].append(i)
        for j, h in zip(at_b[both].tolist(), key_b[both].tolist()):
            if not free_b[j : j + size].all():
                continue
            for i in table[h]:
                if free_a[i : i + size].all() and np.array_equal(a[i : i + size], b[j : j + size]):
                    free_a[i : i + size] = free_b[j : j + size] = False
                    tiles.append((i, j, size))
                    break
        size -= 1
    return tiles


def _item_seeds(least: int):
    def seeds(batches):
        for batch in batches:
            hashes, bounds = tokens(batch.column("text"))
            sizes = np.diff(bounds)
            for width in np.unique(np.minimum(sizes, least)).tolist():
                n = np.where(np.minimum(sizes, least) == width, sizes - width + 1, 0) if width else np.zeros(len(sizes), np.int64)
                row, place = np.repeat(np.arange(len(sizes)), n), packed.ragged(np.zeros(len(sizes), np.int64), n)
                yield pa.record_batch({
                    "item": batch.column("item").take(pa.array(row)), "key": pa.array(windows(hashes, width)[bounds[row] + place].view(np.int64)),
                    "place": pa.array(place, pa.int32()), "width": pa.array(np.full(len(row), width), pa.int32()), "size": pa.array(sizes[row], pa.int32()),
                })

    return seeds


def _document_hits(widths: list[int], shortest: int, seeds: np.ndarray | None):
    """(text, key) of the distinct windows of each text, those among `seeds` if given."""
    def hits(batches):
        for _, rows in packed.blocks(batches, "text", BLOCK_BYTES):
            hashes, bounds = tokens(rows.column("text"))
            sizes = np.diff(bounds)
            for width in widths:
                key = windows(hashes, width)
                row = np.repeat(np.arange(rows.num_rows), sizes)
                use = row[: len(key)] == row[width - 1 :][: len(key)]
                if width < shortest:
                    use &= sizes[row[: len(key)]] == width
                if seeds is not None:
                    use &= seeds[np.minimum(np.searchsorted(seeds, key), len(seeds) - 1)] == key if len(seeds) else False
                key, row = key[use], row[: len(key)][use]
                order = np.lexsort((key, row))
                key, row = key[order], row[order]
                new = np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))[: len(key)]
                yield pa.record_batch({"name": rows.column("name").take(pa.array(row[new])), "key": pa.array(key[new].view(np.int64))})

    return hits


def _near(text: np.ndarray, item: np.ndarray, least: int) -> np.ndarray:
    """The parts of the text that seeds of the item cover, parted by a token of no text."""
    at = np.flatnonzero(np.isin(windows(text, least), windows(item, least)))
    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + least, -1)
    use = np.cumsum(cover[:-1]) > 0
    last = np.flatnonzero(use & ~np.append(use[1:], False)) + 1
    return np.insert(text, last, _U(0))[np.insert(use, last, True)]


def _tiled(least: int):
    def run(batches):
        for batch in batches:
            covered, sizes, tiles = [], [], []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                item, text = tokens(row.column("item_text"))[0], tokens(row.column("text"))[0]
                width = min(least, len(item))
                found = tile(item, _near(text, item, width), width)
                covered.append(sum(n for *_, n in found))
                sizes.append(len(item))
                tiles.append(len(found))
            yield pa.record_batch({
                "name": batch.column("name"), "item": batch.column("item"), "covered": pa.array(covered, pa.int64()),
                "item_tokens": pa.array(sizes, pa.int64()), "tiles": pa.array(tiles, pa.int64()),
            })

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: int = LEAST, threshold: float = THRESHOLD,
    id_column: str = "doc_id", item_column: str = "item_id", text: str = "text", shortest: int = SHORTEST,
) -> DataFrame:
    """(doc_id, item_id, covered, item_tokens, tiles) of every pair at or over the threshold."""
    path = work_path(docs.sparkSession, "tiling")
    name = F.unhex(F.sha2("text", 256))  # equal texts are compared once
    plain = docs.selectExpr(f"cast(`{id_column}` as bigint) AS doc_id", f"`{text}` AS text").where("text IS NOT NULL")
    plain = plain.withColumn("name", name)
    items = benchmark.selectExpr(f"`{item_column}` AS item_id", f"`{text}` AS text").where("text IS NOT NULL")
    items = items.withColumn("item", name)
    distinct = items.select("item", "text").dropDuplicates(["item"])
    seeds = distinct.mapInArrow(_item_seeds(least), "item binary, key long, place int, width int, size int")
    seeds = packed.staged(seeds, f"{path}/seeds")
    widths = sorted(r.width for r in seeds.select("width").distinct().collect())  # at most `least`
    keys, known = seeds.select("key").distinct(), None
    if keys.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:  # 8 bytes each
        known = np.sort(keys.toArrow().column("key").to_numpy().view(np.uint64))
    hits = plain.select("name", "text").mapInArrow(_document_hits(widths, shortest, known), "name binary, key long")
    if known is None:
        hits = hits.join(keys, "key", "left_semi")
    hits = packed.staged(hits.distinct(), f"{path}/hits")
    # What share of an item do its seeds in the text cover? Tiles cannot cover more.
    covers = seeds.select("item", "key", "size", F.explode(F.sequence("place", F.col("place") + F.col("width") - 1)).alias("at"))
    most = covers.groupBy("item", "key", "size").agg(F.count_distinct("at").alias("most"))
    holders = seeds.groupBy("key").agg(F.count_distinct("item").alias("holders"))
    common_first = Window.partitionBy("item").orderBy(F.desc("holders"), "key").rowsBetween(Window.unboundedPreceding, 0)
    most = most.join(holders, "key").withColumn("rare", F.sum("most").over(common_first) >= threshold * F.col("size"))
    most = packed.staged(most.select("item", "key", "size", "most", "rare"), f"{path}/most")
    met = hits.join(most.where("rare").select("key", "item"), "key").select("name", "item").distinct()
    likely = (
        met.join(hits, "name").join(most, ["item", "key"]).groupBy("name", "item", "size").agg(F.sum("most").alias("most"))
        .where(F.col("most") >= threshold * F.col("size")).select("name", "item")
    )
    likely = packed.staged(likely, f"{path}/likely")
    texts = plain.join(likely.select("name").distinct(), "name", "left_semi").select("doc_id", "name", "text")
    texts = packed.staged(texts, f"{path}/texts")
    pairs = likely.join(texts.select("name", "text").dropDuplicates(["name"]), "name")
    pairs = pairs.join(distinct.withColumnRenamed("text", "item_text"), "item")
    tiled = pairs.select("name", "item", "text", "item_text").repartition("name", "item").mapInArrow(
        _tiled(least), "name binary, item binary, covered long, item_tokens long, tiles long"
    )
    over = tiled.where(F.col("covered") >= threshold * F.col("item_tokens"))
    return texts.select("doc_id", "name").join(over, "name").join(items.select("item", "item_id"), "item").select(
        "doc_id", "item_id", "covered", "item_tokens", "tiles"
    )
