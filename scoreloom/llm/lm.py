"""Language-model scoring by deleted interpolation.

A bigram, a unigram and a uniform estimate are mixed by weights that depend on how often
the context was seen (powers of two). Counts come from all training rows. The weights
are learned by expectation-maximisation: the held-out part of the training rows is
deleted from the counts, and its n-grams are predicted by what is left.

    P(w | h) = a2[b] c(h, w) / c(h) + a1[b] c(w) / N + a0[b] / (V + 1),   b = bucket of c(h)

Plan. Texts are cut into blocks of some MB whose distinct words get local numbers, so
that a text travels as a short list of numbers. Every count is a sum over blocks:

1. distinct words of a block go to hash buckets and come back with global counts
   (`counted`, stored: block, numbers, words, counts);
2. distinct bigrams of a block go to hash buckets, but only those whose two words occur
   outside the block as well (else the block's own count is the global one); back come
   the counts that differ from the block's own (`found`, stored), and for the held-out
   bigrams one event each (count, context count, word count, times);
3. each step of the expectation-maximisation is one aggregate over the stored events, of
   which a few sums per context bucket reach the driver;
4. blocks meet their bigram counts again and score their texts.

A word or bigram is at most one entry per block, so no key is hot; buckets and blocks
bound the memory of a task. Everything gathered grows with the corpus.

Defined results: null text is empty and scores its end token; a null id or repeated rows
are rows like any other; a row whose `train` is null is not trained on; without training
rows every token has the uniform probability. Only the id column is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import packed
from scoreloom.session import work_path

BLOCK_BYTES = 3 << 20
BUCKET_BYTES = 8 << 20
END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
MAX_BUCKET = 40
STEPS = 12
LEAST = 1e-6  #: least weight of the uniform estimate, so that no word is impossible

_BLOCK = (
    "block long, bucket int, docs array<long>, train binary, held binary, sizes binary, seq binary, "
    "keys binary, n_train binary, n_held binary, n_rest binary"
)
_ASK = "block long, bucket int, keys binary, n_train binary, n_held binary, n_rest binary"
_SUMS = "block long, bucket int, n_train binary, n_held binary, n_all binary, new long"
_COUNTED = (
    "block long, docs array<long>, train binary, held binary, sizes binary, seq binary, keys binary, "
    "c_train binary, c_held binary, elsewhere binary, n_tokens long, n_held_tokens long, new long"
)
_FOUND = "block long, bucket int, at binary, counts binary, e_count binary, e_context binary, e_word binary, e_times binary"


def _frame(columns: dict, schema: str, n: int) -> pa.RecordBatch:
    """A batch with the columns of the schema; the others are null."""
    arrays, names = [], []
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    for field in schema.split(", "):
        name, kind = field.split(" ")
        names.append(name)
        value = columns.get(name)
        arrays.append(pa.nulls(n, kinds[kind]) if value is None else pa.array(value, kinds[kind]))
    return pa.record_batch(arrays, names=names)


def _split(buckets: int):
    def split(batches):
        for block, rows in packed.blocks(batches, "text", BLOCK_BYTES):
            hashes, bounds = packed.hashed_words(rows.column("text"))
            hashes = np.insert(hashes, bounds[1:], END)
            sizes = np.diff(bounds) + 1
            train = rows.column("train").fill_null(False).to_numpy(zero_copy_only=False)
            held = rows.column("held").fill_null(False).to_numpy(zero_copy_only=False) & train
            keys, seq = np.unique(hashes, return_inverse=True)
            in_train, in_held = np.repeat(train, sizes), np.repeat(held, sizes)
            count = lambda mask: np.bincount(seq[mask], minlength=len(keys)).astype(np.uint32)
            n_train, n_held, n_rest = count(in_train), count(in_held), count(~in_train)
            # Frequent words get small numbers, which compress better.
            order = np.argsort(-(n_train.astype(np.int64) + n_rest), kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            seq = rank[seq].astype(np.uint16 if len(keys) < 1 << 16 else np.uint32)
            yield _frame({
                "block": [block], "docs": [rows.column("doc_id").to_pylist()],
                "train": [packed.pack(train)], "held": [packed.pack(held)], "sizes": [packed.pack(sizes, np.uint32)],
                "seq": [bytes([seq.itemsize]) + packed.pack(seq)], "keys": [packed.pack(keys[order])],
                "n_train": [packed.pack(n_train[order])], "n_held": [packed.pack(n_held[order])],
                "n_rest": [packed.pack(n_rest[order])],
            }, _BLOCK, 1)
            asked = list(packed.bucket_ranges(keys, buckets))
            yield _frame({
                "block": [block] * len(asked), "bucket": [b for b, _ in asked],
                "keys": [packed.pack_sorted(keys[s]) for _, s in asked],
                "n_train": [packed.pack(n_train[s]) for _, s in asked],
                "n_held": [packed.pack(n_held[s]) for _, s in asked],
                "n_rest": [packed.pack(n_rest[s]) for _, s in asked],
            }, _BLOCK, len(asked))

    return split


def _words_asked(batches):
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column("bucket")))
        yield batch.select(["block", "bucket", "keys", "n_train", "n_held", "n_rest"])


def _merged(table: pa.Table, names: list[str]):
    """Distinct keys of all messages of a bucket, places of the entries, sums by key, message bounds."""
    keys = [packed.unpack_sorted(x) for x in table.column("keys").to_pylist()]
    bounds = np.cumsum([0, *map(len, keys)])
    values, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    entries = {n: np.concatenate([packed.unpack(x, np.uint32) for x in table.column(n).to_pylist()]) for n in names}
    sums = {n: np.bincount(place, weights=v, minlength=len(values)).astype(np.int64) for n, v in entries.items()}
    return first, place, entries, sums, bounds


def _sum_words(table: pa.Table) -> pa.Table:
    first, place, _, sums, bounds = _merged(table, ["n_train", "n_held", "n_rest"])
    total = sums["n_train"] + sums["n_rest"]
    new = np.zeros(bounds[-1], np.int64)
    new[first] = sums["n_train"] > 0  # each training word is new in one block
    cut = lambda v, kind: [packed.pack(v[place[a:b]], kind) for a, b in zip(bounds, bounds[1:])]
    return pa.Table.from_batches([_frame({
        "block": table.column("block").to_pylist(), "bucket": table.column("bucket").to_pylist(),
        "n_train": cut(sums["n_train"], np.int64), "n_held": cut(sums["n_held"], np.int64), "n_all": cut(total, np.int64),
        "new": [int(new[a:b].sum()) for a, b in zip(bounds, bounds[1:])],
    }, _SUMS, table.num_rows)])


def _meet_words(own: pa.Table, sums: pa.Table) -> pa.Table:
    own = own.filter(pc.is_null(own.column("bucket")))
    row = {n: own.column(n)[0].as_py() for n in own.column_names}
    keys = packed.unpack(row["keys"], np.uint64)
    order = np.argsort(keys)
    sums = sums.sort_by("bucket")

    def gathered(name: str) -> np.ndarray:
        out = np.empty(len(keys), np.int64)
        out[order] = np.concatenate([packed.unpack(x, np.int64) for x in sums.column(name).to_pylist()])
        return out

    local = {n: packed.unpack(row[n], np.uint32).astype(np.int64) for n in ("n_train", "n_held", "n_rest")}
    elsewhere = gathered("n_all") > local["n_train"] + local["n_rest"]
    return pa.Table.from_batches([_frame({
        **{n: [row[n]] for n in ("block", "docs", "train", "held", "sizes", "seq", "keys")},
        "c_train": [packed.pack(gathered("n_train"))], "c_held": [packed.pack(gathered("n_held"))],
        "elsewhere": [packed.pack(elsewhere)], "n_tokens": [int(local["n_train"].sum())],
        "n_held_tokens": [int(local["n_held"].sum())], "new": [sum(sums.column("new").to_pylist())],
    }, _COUNTED, 1)])


class _Block:
    """One block's tokens, word counts and distinct bigrams."""

    def __init__(self, row: dict):
        self.docs = row["docs"]
        self.sizes = packed.unpack(row["sizes"], np.uint32).astype(np.int64)
        kind = np.uint16 if row["seq"][0] == 2 else np.uint32
        self.word = packed.unpack(row["seq"][1:], kind).astype(np.int64)
        keys = packed.unpack(row["keys"], np.uint64)
        n = len(keys)
        ends = np.cumsum(self.sizes)
        self.first = ends - self.sizes
        before = np.empty(len(self.word), np.int64)
        before[1:] = self.word[:-1]
        before[self.first] = n  # the begin of a text, which stands before as many words as there are ends
        end = int(self.word[-1])
        c_train, c_held = (packed.unpack(row[c], np.int64) for c in ("c_train", "c_held"))
        self.c_word, self.h_word = c_train, c_held
        self.c_context, self.h_context = np.append(c_train, c_train[end]), np.append(c_held, c_held[end])
        self.before = before
        train, held = (packed.unpack(row[c], bool) for c in ("train", "held"))
        code = before * n + self.word
        pairs, self.pair = np.unique(code, return_inverse=True)
        self.left, self.right = pairs // n, pairs % n
        both = np.append(keys, BEGIN)
        with np.errstate(over="ignore"):
            mixed = packed.mix(both[self.left] * np.uint64(0xD1342543DE82EF95) + packed.mix(keys[self.right]))
        count = lambda mask: np.bincount(self.pair[np.repeat(mask, self.sizes)], minlength=len(pairs))
        self.n_train, self.n_held = count(train), count(held)
        elsewhere = packed.unpack(row["elsewhere"], bool)
        ask = (np.append(elsewhere, True)[self.left] & elsewhere[self.right]) | (self.n_held > 0)
        asked = np.flatnonzero(ask)
        self.asked = asked[np.argsort(mixed[asked])]
        self.keys = mixed[self.asked]


_ASK_PAIRS = "block long, bucket int, keys binary, n_train binary, n_held binary, context binary, word binary"


def _pairs_asked(buckets: int):
    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = _Block(row)
                for bucket, s in packed.bucket_ranges(b.keys, buckets):
                    own = b.asked[s]
                    held = own[b.n_held[own] > 0]
                    left, right = b.left[held], b.right[held]
                    yield _frame({
                        "block": [row["block"]], "bucket": [bucket], "keys": [packed.pack_sorted(b.keys[s])],
                        "n_train": [packed.pack(b.n_train[own], np.uint32)], "n_held": [packed.pack(b.n_held[own], np.uint32)],
                        "context": [packed.pack(b.c_context[left] - b.h_context[left])],
                        "word": [packed.pack(b.c_word[right] - b.h_word[right])],
                    }, _ASK_PAIRS, 1)

    return ask


def _sum_pairs(table: pa.Table) -> pa.Table:
    _, place, entries, sums, bounds = _merged(table, ["n_train", "n_held"])
    differ = sums["n_train"][place] != entries["n_train"]
    at, counts = [], []
    for a, b in zip(bounds, bounds[1:]):
        where = np.flatnonzero(differ[a:b])
        at.append(packed.pack(where, np.uint32))
        counts.append(packed.pack(sums["n_train"][place[a:b][where]], np.int64))
    # One event per held-out bigram; every block that holds it sent the same context and word counts.
    join = lambda name: np.concatenate([packed.unpack(x, np.int64) for x in table.column(name).to_pylist()])
    holders = place[entries["n_held"] > 0]
    event, index = np.unique(holders, return_index=True)
    blank = [None] * (table.num_rows - 1)
    return pa.Table.from_batches([_frame({
        "block": table.column("block").to_pylist(), "bucket": table.column("bucket").to_pylist(), "at": at, "counts": counts,
        "e_count": [packed.pack((sums["n_train"] - sums["n_held"])[event]), *blank],
        "e_context": [packed.pack(join("context")[index]), *blank], "e_word": [packed.pack(join("word")[index]), *blank],
        "e_times": [packed.pack(sums["n_held"][event]), *blank],
    }, _FOUND, table.num_rows)])


def _context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then one bucket per power of two."""
    return np.minimum(np.frexp(count.astype(np.float64))[1], MAX_BUCKET)


def _estimates(count, context, word, total: int, kinds: int) -> np.ndarray:
    """Bigram, unigram and uniform estimates, one row each."""
    bigram = np.divide(count, context, out=np.zeros(len(count)), where=context > 0)
    unigram = word / total if total else np.zeros(len(count))
    return np.stack([bigram, unigram, np.full(len(count), 1.0 / (kinds + 1))])


def _expectations(weights: np.ndarray, total: int, kinds: int):
    def step(batches):
        sums = np.zeros((3, MAX_BUCKET + 1))
        for batch in batches:
            for row in batch.to_pylist():
                count, context, word, times = (packed.unpack(row[c], np.int64) for c in ("e_count", "e_context", "e_word", "e_times"))
                bucket = _context_bucket(context)
                share = _estimates(count, context, word, total, kinds) * weights[:, bucket]
                share *= times / share.sum(0)
                for k in range(3):
                    sums[k] += np.bincount(bucket, weights=share[k], minlength=MAX_BUCKET + 1)
        used = np.flatnonzero(sums.sum(0))
        yield pa.record_batch({"bucket": pa.array(used, pa.int32()), **{f"s{k}": pa.array(sums[k][used]) for k in range(3)}})

    return step


def learn_weights(found: DataFrame, total: int, kinds: int, steps: int = STEPS) -> np.ndarray:
    """Mixture weights, 3 by context bucket; `total` and `kinds` are without the held-out rows' tokens."""
    weights = np.full((3, MAX_BUCKET + 1), 1 / 3)
    weights[:, 0] = 0, 0.5, 0.5  # an unseen context says nothing
    if not total:
        weights[:, :] = np.array([[0], [0], [1]])
        return weights
    events = found.where("e_times IS NOT NULL").select("e_count", "e_context", "e_word", "e_times")
    for _ in range(steps):
        sums = events.mapInArrow(_expectations(weights, total, kinds), "bucket int, s0 double, s1 double, s2 double")
        for r in sums.groupBy("bucket").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(3)]).collect():
            new = np.array([r.s0, r.s1, r.s2])
            new = new / new.sum()
            new[2] = max(new[2], LEAST)
            weights[:, r.bucket] = new / new.sum()
    return weights


def _score(weights: np.ndarray, total: int, kinds: int, buckets: int):
    def score(own: pa.Table, found: pa.Table) -> pa.Table:
        b = _Block({n: own.column(n)[0].as_py() for n in own.column_names})
        count = b.n_train.astype(np.int64)
        found = {r["bucket"]: r for r in found.to_pylist()}
        for bucket, s in packed.bucket_ranges(b.keys, buckets):
            row = found[bucket]
            count[b.asked[s][packed.unpack(row["at"], np.uint32)]] = packed.unpack(row["counts"], np.int64)
        context = b.c_context[b.left]
        mixed = _estimates(count, context, b.c_word[b.right], total, kinds) * weights[:, _context_bucket(context)]
        log = np.log10(mixed.sum(0))[b.pair]
        known = b.c_word[b.word]
        base = np.log10((known + 1) / (total + kinds + 1))
        add = lambda x: np.add.reduceat(x, b.first)  # noqa: E731  every text has its end token
        return pa.table({
            "doc_id": pa.array(b.docs, pa.int64()), "n_tokens": pa.array(b.sizes),
            "n_known": pa.array(add((known > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(b.docs), total, np.int64)),
            "base_score": pa.array(add(base)), "score": pa.array(add(log)),
        })

    return score


def score_texts(
    docs: DataFrame, train: Column, held: Column, id_column: str = "doc_id", text: str = "text", steps: int = STEPS
) -> DataFrame:
    """Log10 probability of each text. `train` marks the rows to learn from, `held` the
    part of them whose counts are deleted to learn the weights."""
    plain = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"), train.alias("train"), held.alias("held")
    )
    size = packed.text_size(plain)
    buckets = packed.parts(size, BUCKET_BYTES)
    split = plain.mapInArrow(_split(buckets), _BLOCK).repartition(buckets, "block")
    sums = split.mapInArrow(_words_asked, _ASK).groupBy("bucket").applyInArrow(_sum_words, _SUMS)
    path = work_path(docs.sparkSession, "lm")
    counted = split.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(_meet_words, _COUNTED)
    counted = packed.staged(counted, f"{path}/counted")
    total, n_held, kinds = counted.agg(F.sum("n_tokens"), F.sum("n_held_tokens"), F.sum("new")).first()
    total, n_held, kinds = total or 0, n_held or 0, kinds or 0
    asked = counted.mapInArrow(_pairs_asked(buckets), _ASK_PAIRS).repartition(buckets, "bucket")
    found = packed.staged(asked.groupBy("bucket").applyInArrow(_sum_pairs, _FOUND), f"{path}/found")
    weights = learn_weights(found, total - n_held, kinds, steps)
    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    back = found.select("block", "bucket", "at", "counts")
    return counted.repartition(buckets, "block").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        _score(weights, total, kinds, buckets), schema
    )
