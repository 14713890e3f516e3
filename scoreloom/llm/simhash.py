"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has 64 bits; a bit is 1 if more than half of the text's shingle hashes
set it. Two fingerprints link when they differ in at most two bits. Cut into two halves of 32
bits, one half then differs in at most one bit, so the two are equal once that bit is left
out. Every fingerprint is therefore indexed under 64 variants, each a half without one bit;
fingerprints that share a variant are compared whole.

Plan. Copies have one fingerprint, so only distinct fingerprints are indexed. Their variants
are shuffled and sorted; a task walks over groups of one variant. A group of at most `SMALL`
members is compared on the spot. The members of a larger group are not paired: they leave
the task and are indexed once more, by the other half cut into two quarters, one of which
again differs in at most one bit. A group that is still large has at most 18 free bits; its
members go to the 153 variants without two of those bits, where all that meet are links by
themselves and at most four. So no group makes more than `SMALL` pairs a member, without a cap.
Links become classes by `components`, on fingerprints; ids come in at the end.

Defined results: null, empty and blank texts have fingerprint zero and link like any other;
fewer words than a shingle are one shingle; a null id takes no part in the least id, so a class
of null ids only has no component id; repeated rows stay; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import components, packed
from scoreloom.session import work_path

SHINGLE = 3  # words
SEED = 42
DISTANCE = 2  # bits; the halves and quarters below rest on it
SMALL = 64  # members of a group that are compared pair by pair
PIECE = 1 << 20  # bytes of a text that are cut into words at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LOW, _BYTE = (1 << 32) - 1, 8
_U = np.uint64


def pieces(text: bytes, size: int = PIECE):
    """The text in parts of about `size` bytes, cut at white space."""
    start = 0
    while start < len(text):
        end = _SPACE.search(text, start + size)
        end = end.start() if end else len(text)
        yield text[start:end]
        start = end


def shingle_hashes(text: bytes, shingle: int = SHINGLE):
    """Hashes of all shingles of a text, in arrays."""
    carry, seen = [], False
    for piece in pieces(text):
        words = carry + piece.lower().split()  # bytes: A-Z and ASCII white space only
        if len(words) < shingle:
            carry = words
            continue
        seen = True
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        line, digest = b" ".join(words), xxhash.xxh64_intdigest
        hashes = (digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist()))
        yield np.fromiter(hashes, _U, len(starts))
        carry = words[len(words) - shingle + 1 :]
    if carry and not seen:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], _U)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of each bit over the shingle hashes; zero for a text without words."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, shingle):
        total += len(hashes)
        for part in np.array_split(hashes, -(-len(hashes) // 4096)):
            bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, _BYTE), axis=1)
            ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            texts = pc.cast(batch.column(1).fill_null(""), pa.binary())
            found = np.array([fingerprint(t.as_py(), shingle) for t in texts], _U)
            yield pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "bits"])

    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, bits) for every row; `bits` is the fingerprint as a signed long."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, bits long")


def _without(value: Column, bit: Column) -> Column:
    return value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))))


def _part(value: Column, number: Column, width: int) -> Column:
    """The number-th part of `width` bits, from the lowest."""
    shifted = F.call_function("shiftrightunsigned", value, (number * width).cast("int"))
    return shifted.bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def variants(rows: DataFrame) -> DataFrame:
    """(key, bits): every fingerprint under its 64 halves without one bit."""
    keyed = rows.select("bits", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
    half = _part(F.col("bits"), F.floor(F.col("v") / 32), 32)
    key = F.call_function("shiftleft", F.col("v").cast("long"), F.lit(32)).bitwiseOR(_without(half, F.col("v") % 32))
    return keyed.select(key.alias("key"), "bits")


def finer_variants(rows: DataFrame) -> DataFrame:
    """(key, bits): members of large groups under the quarters of their other half without one bit."""
    keyed = rows.select("key", "bits", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("v"))
    # A key below 2^37 indexes the low half, so that the other one holds quarters 2 and 3.
    first = F.when(F.call_function("shiftright", F.col("key"), F.lit(37)) == 0, 2).otherwise(0)
    quarter = _part(F.col("bits"), first + F.floor(F.col("v") / 16), 16)
    finer = F.call_function("shiftleft", F.col("key"), F.lit(21)).bitwiseOR(
        F.call_function("shiftleft", F.col("v").cast("long"), F.lit(16))
    )
    return keyed.select(finer.bitwiseOR(_without(quarter, F.col("v") % 16)).alias("key"), "bits")


def last_variants(rows: DataFrame) -> DataFrame:
    """(key, bits): members of groups that are still large, without two of their 18 free bits.

    Who meets here differs in at most these two bits, so a group is at most four
    fingerprints. The key is a hash of the rest, and pairs are verified like all others.
    """
    half = _part(F.col("key"), F.lit(0), 59)
    half_bit = F.call_function("shiftright", half, F.lit(53))  # 0..63: the bit left out of the half
    v = _part(F.call_function("shiftright", F.col("key"), F.lit(16)), F.lit(0), 5)
    base = F.when(half_bit < 32, 32).otherwise(0)  # where the other half starts
    own = base + v  # the bit left out of the quarter
    other = base + F.when(v < 16, 16).otherwise(0)  # where the free quarter starts
    free = F.concat(F.array(half_bit.cast("int"), own.cast("int")), F.sequence(other.cast("int"), (other + 15).cast("int")))
    pair = rows.select("key", "bits", free.alias("free"), F.explode(F.sequence(F.lit(0), F.lit(18 * 18 - 1))).alias("p"))
    a, b = F.floor(F.col("p") / 18).cast("int"), (F.col("p") % 18).cast("int")
    pair = pair.where(a < b).select("bits", F.element_at("free", a + 1).alias("a"), F.element_at("free", b + 1).alias("b"))
    rest = _without(_without(F.col("bits"), F.col("a")), F.col("b"))
    return pair.select(F.xxhash64("a", "b", rest).alias("key"), "bits").distinct()


def _meet(small: int | None):
    """Walks over rows sorted by key: pairs of small groups, members of large ones."""

    def emit(keys, bits):
        group = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
        sizes = np.diff(np.append(group, len(keys)))
        size = np.repeat(sizes, sizes)
        left, right = [], []
        step, most = 1, int(sizes.max(initial=0)) if small is None else small
        alive = np.flatnonzero(size <= most)
        place = np.arange(len(keys)) - np.repeat(group, sizes)
        while step < most and len(alive := alive[place[alive] + step < size[alive]]):
            a, b = bits[alive], bits[alive + step]
            near = np.bitwise_count(a ^ b) <= DISTANCE
            left.append(a[near])
            right.append(b[near])
            step += 1
        if left:
            a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
            yield pa.record_batch([pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(b)], ["key", "a", "b"])
        large = size > most
        yield from members(keys[large], bits[large])

    def members(keys, bits):
        if len(keys):
            yield pa.record_batch(
                [pa.array(keys), pa.array(bits.view(np.int64)), pa.nulls(len(keys), pa.int64())], ["key", "a", "b"]
            )

    def run(batches):
        keys, bits, hot = np.zeros(0, np.int64), np.zeros(0, _U), None
        for batch in batches:
            keys = np.append(keys, batch.column(0).to_numpy())
            bits = np.append(bits, batch.column(1).to_numpy().view(_U))
            if hot is not None:  # the rest of a group that is already known to be large
                n = int(np.searchsorted(keys, hot, "right"))
                yield from members(keys[:n], bits[:n])
                keys, bits = keys[n:], bits[n:]
                if not len(keys):
                    continue
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            hot = None
            if last:
                yield from emit(keys[:last], bits[:last])
            keys, bits = keys[last:], bits[last:]
            if small is not None and len(keys) > small:
                hot = keys[-1]
                yield from members(keys, bits)
                keys, bits = keys[:0], bits[:0]
        if len(keys):
            yield from emit(keys, bits)

    return run


def _met(rows: DataFrame, small: int | None, parts: int, path: str) -> tuple[DataFrame, DataFrame]:
    """(links a, b) and (members key, bits) of the groups of one index."""
    dealt = rows.repartition(parts, "key").sortWithinPartitions("key")
    met = packed.staged(dealt.mapInArrow(_meet(small), "key long, a long, b long"), path)
    return met.where("key IS NULL").select("a", "b"), met.where("key IS NOT NULL").select("key", F.col("a").alias("bits"))


def links(distinct: DataFrame, size: int, small: int = SMALL) -> DataFrame:
    """(a, b): distinct fingerprints that differ in at most two bits, some perhaps twice.

    `size` is the number of fingerprints; it sizes shuffles and never changes a result.
    """
    path = work_path(distinct.sparkSession, "simhash")
    parts = packed.parts(size * 64, 4_000_000)
    near, large = _met(variants(distinct), small, parts, f"{path}/halves")
    finer, larger = _met(finer_variants(large), small, parts, f"{path}/quarters")
    last, _ = _met(last_variants(larger), None, parts, f"{path}/bits")
    return near.unionByName(finer).unionByName(last)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, small: int = SMALL
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs`."""
    spark = docs.sparkSession
    path = work_path(spark, "fingerprints")
    rows = packed.staged(fingerprints(docs, doc_id, text, shingle), f"{path}/rows")
    counted = rows.groupBy("bits").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    distinct = packed.staged(counted, f"{path}/distinct")
    n, total = distinct.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    classes = components.smallest_member(links(distinct.select("bits"), n, small))
    named = distinct.join(classes, distinct["bits"] == classes["node"], "left").select(
        "bits", "n", "least", F.coalesce("component", "bits").alias("class")
    )
    named = packed.staged(named, f"{path}/classes")
    least = named.groupBy("class").agg(F.min("least").alias("component_id"))
    named = named.join(least, "class").select("bits", "n", "component_id")
    # Copies share a fingerprint: those of over a thousandth of all rows are under a thousand.
    often = total / 1000 + 1
    hot = named.where(F.col("n") > often).select("bits", "component_id")
    rest = named.where(F.col("n") <= often).select("bits", F.col("component_id").alias("own"), F.lit(True).alias("found"))
    out = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "bits", "left")
    direct = out.where("hot").select("doc_id", "bits", "component_id")
    dealt = out.where("hot IS NULL").select("doc_id", "bits").join(rest, "bits").select(
        "doc_id", "bits", F.col("own").alias("component_id")
    )
    return direct.unionByName(dealt).select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
