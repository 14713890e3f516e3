"""Byte-level BPE by a global shuffle of distinct words, and decoding.

`encode` explodes texts into pre-tokens with positions and encodes every distinct
pre-token of the whole table once:

1. Each task cuts its rows into blocks of some MB of text and numbers the distinct
   pre-tokens of a block. A text becomes the list of its words' numbers, in the order of
   their positions; the block's words leave as messages dealt by the words' hash.
2. In each hash bucket equal words of all blocks meet, are encoded once, and the ids
   return to every block that asked. A word is at most one entry per block, so the most
   frequent word of the language is no heavier than a block count.
3. Each block joins words and ids by number and reassembles its texts by position.

Texts cross the network once, as compressed word numbers; blocks and buckets bound the
memory of a task. `decode` joins ids with the token-byte table of the vocabulary file.

Defined results: a null text is the empty text and gives no ids; repeated rows and null
ids of documents are rows like any other; only the id column is kept; an id outside the
vocabulary decodes to no bytes.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections import defaultdict
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zlib
import zstandard
from pyspark.sql import DataFrame

from scoreloom.llm import packed

BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 8 << 20
DECODE_IDS = 1 << 19
NO_RANK = 1 << 62


@lru_cache(2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(2)
def token_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens in the order of their ids, and where each one starts."""
    ranks = load_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([0, *map(len, tokens)])


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merges the pair of lowest rank, leftmost first, until no pair has a rank."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 100:
        return _encode_long(word, ranks)
    pieces = [word[i : i + 1] for i in range(len(word))]
    while len(pieces) > 1:
        pairs = [ranks.get(a + b, NO_RANK) for a, b in zip(pieces, pieces[1:])]
        best = min(pairs)
        if best == NO_RANK:
            break
        at = pairs.index(best)
        pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
    return [ranks[x] for x in pieces]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for long words, in n log n: a heap of pairs over linked pieces."""
    n = len(word)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def push(at: int) -> None:
        middle = ends[at]
        if middle < n and (rank := ranks.get(word[at : ends[middle]])) is not None:
            heap.append((rank, at, ends[middle])) if not ready else heapq.heappush(heap, (rank, at, ends[middle]))

    ready = False
    for i in range(n):
        push(i)
    heapq.heapify(heap)
    ready = True
    while heap:
        _, at, end = heapq.heappop(heap)
        middle = ends[at]
        if middle < 0 or middle >= n or ends[middle] != end:
            continue  # one of the two pieces has changed since
        ends[at], ends[middle] = end, -1
        if end < n:
            before[end] = at
        push(at)
        if at:
            push(before[at])
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return out


_SPLIT = pa.schema([
    ("block", pa.int64()), ("bucket", pa.int32()), ("docs", pa.list_(pa.int64())), ("sizes", pa.binary()), ("seq", pa.binary()),
    ("numbers", pa.binary()), ("lengths", pa.binary()), ("words", pa.binary()),
])
_SPLIT_SQL = "block long, bucket int, docs array<long>, sizes binary, seq binary, numbers binary, lengths binary, words binary"
_ASKED_SQL = "block long, bucket int, lengths binary, words binary"
_CODED_SQL = "block long, bucket int, lengths binary, ids binary"


def _splitter(pattern: str, buckets: int):
    def split(batches):
        find = regex.compile(pattern).findall
        pack = zstandard.ZstdCompressor(level=3).compress
        for block, rows in packed.blocks(batches, "text", BLOCK_BYTES):
            numbers = defaultdict(count().__next__)
            seqs = [np.fromiter(map(numbers.__getitem__, find(t or "")), np.uint32) for t in rows.column("text").to_pylist()]
            # Frequent words get small numbers, which compress better.
            seen = np.bincount(np.concatenate(seqs), minlength=len(numbers)) if numbers else np.zeros(0, np.int64)
            order = np.argsort(-seen, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            seq = rank[np.concatenate(seqs)].astype(np.uint16 if len(order) < 1 << 16 else np.uint32)
            yield pa.record_batch([
                pa.array([block]), pa.nulls(1, pa.int32()), pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([packed.pack([len(x) for x in seqs], np.uint32)]), pa.array([bytes([seq.itemsize]) + packed.pack(seq)]),
                *[pa.nulls(1, pa.binary())] * 3,
            ], schema=_SPLIT)
            asked = defaultdict(list)
            for word, i in sorted((w.encode(), i) for w, i in numbers.items()):  # sorted words compress better
                asked[zlib.crc32(word) % buckets].append((word, i))
            m = len(asked)
            yield pa.record_batch([
                pa.array(np.full(m, block)), pa.array(list(asked), pa.int32()), pa.nulls(m, pa.list_(pa.int64())), *[pa.nulls(m, pa.binary())] * 2,
                pa.array([packed.pack(rank[[i for _, i in x]]) for x in asked.values()], pa.binary()),
                pa.array([packed.pack([len(w) for w, _ in x], np.uint32) for x in asked.values()], pa.binary()),
                pa.array([pack(b"".join([w for w, _ in x])) for x in asked.values()], pa.binary()),
            ], schema=_SPLIT)

    return split


def _messages(batches):
    """The words that blocks ask for, without the texts."""
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column("bucket")))
        yield batch.select(["block", "bucket", "lengths", "words"])


def _encoder(path: str):
    def encode_bucket(table: pa.Table) -> pa.Table:
        ranks, known = load_ranks(path), {}
        unpack = zstandard.ZstdDecompressor().decompress
        lengths_out, ids_out = [], []
        for lengths, words in zip(table.column("lengths").to_pylist(), table.column("words").to_pylist()):
            at, counts, ids, words = 0, [], [], unpack(words)
            for n in packed.unpack(lengths, np.uint32).tolist():
                word = words[at : at + n]
                at += n
                found = known.get(word)
                if found is None:
                    found = known[word] = array("I", encode_word(word, ranks)).tobytes()
                counts.append(len(found) // 4)
                ids.append(found)
            lengths_out.append(packed.pack(counts, np.uint32))
            ids_out.append(packed.pack(np.frombuffer(b"".join(ids), np.uint32)))
        return pa.table({
            "block": table.column("block"), "bucket": table.column("bucket"),
            "lengths": pa.array(lengths_out, pa.binary()), "ids": pa.array(ids_out, pa.binary()),
        })

    return encode_bucket


def _assemble(texts: pa.Table, coded: pa.Table) -> pa.Table:
    def joined(rows: pa.Table, name: str) -> np.ndarray:
        values = [packed.unpack(x, np.uint32) for x in rows.sort_by("bucket").column(name).to_pylist()]
        return np.concatenate([np.zeros(0, np.uint32), *values]).astype(np.int64)

    numbers = joined(texts.filter(pc.is_valid(texts.column("bucket"))), "numbers")
    lengths, flat = joined(coded, "lengths"), joined(coded, "ids")
    (own,) = texts.filter(pc.is_valid(texts.column("seq"))).to_pylist()
    starts = np.cumsum(lengths) - lengths
    length, start = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    length[numbers], start[numbers] = lengths, starts
    words = packed.unpack(own["seq"][1:], np.uint16 if own["seq"][0] == 2 else np.uint32)
    ids = flat[packed.ragged(start[words], length[words])].astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(length[words])])[np.concatenate([[0], np.cumsum(packed.unpack(own["sizes"], np.uint32), dtype=np.int64)])]
    return pa.table({
        "doc_id": pa.array(own["docs"], pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
    })


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and `ids` of every row; `path` is a file of ranks, `pattern` cuts texts into pre-tokens."""
    plain = docs.selectExpr(f"cast(`{id_column}` as bigint) AS doc_id", f"`{text}` AS text")
    size = packed.text_size(plain)
    buckets = packed.parts(size, BUCKET_BYTES)
    split = plain.mapInArrow(_splitter(pattern, buckets), _SPLIT_SQL).repartition(buckets, "block")
    coded = (
        split.mapInArrow(_messages, _ASKED_SQL).groupBy("bucket").applyInArrow(_encoder(path), _CODED_SQL)
    )
    return split.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(_assemble, "doc_id long, ids array<int>")


def decoder(path: str, ids: str = "ids"):
    """The function of `decode`, from batches with `ids` to batches with `decoded` as well."""
    def decode_batches(batches):
        table, starts = token_table(path)
        lengths = np.append(np.diff(starts), 0)
        for batch in batches:
            sizes = pc.list_value_length(batch.column(ids)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for rows in packed.slices(batch, sizes, DECODE_IDS):
                column = rows.column(ids)
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                flat[(flat < 0) | (flat >= len(lengths) - 1)] = len(lengths) - 1  # outside: no bytes
                n = lengths[flat]
                data = table[packed.ragged(starts[flat], n)]
                sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(sizes)])]
                decoded = pa.Array.from_buffers(
                    pa.binary(), len(column), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
                )
                yield pa.record_batch([*rows.columns, decoded], names=[*rows.schema.names, "decoded"])

    return decode_batches


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds `decoded`, the bytes that the ids stand for."""
    schema = encoded.drop("decoded").schema.add("decoded", "binary")
    return encoded.drop("decoded").mapInArrow(decoder(path, ids), schema)
