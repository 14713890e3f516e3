"""Suffix-array removal of long repeated byte strings.

Every byte covered by a string of `length` bytes that starts anywhere else as well is
removed. Whether two windows of that length are equal is decided by induced suffix sorting
(`induced`), over shards in which all windows that could be equal meet:

1. A block of texts finds, for each window, its anchor: the place of the least hash among
   the window's `GRAM`-byte grams. Equal windows have equal anchors, so the windows are
   dealt by their anchor's gram. Windows with one anchor form a run and share one span.
   The block sends each run's gram and the hash of its span, equal runs once, with counts.
2. A bucket of grams tells every block which of its runs are alone (gram seen once), which
   are repeated as a whole, and which must be compared, window by window, with the other
   spans of their gram; of those repeated spans one copy takes part.
3. Blocks send those spans to shards by gram; a shard sorts its suffixes by induction with
   common prefixes and returns which windows are repeated. A gram with more than `HOT` spans
   is not one shard: its windows are dealt singly, by their own hash, and compared by it.
4. Blocks cut the bytes that repeated windows cover.

Only runs with a repeated gram are sorted, so a corpus without repeats sorts nothing; copies
arrive as counts. Grams and spans are compared by 64-bit hash, windows by their bytes.
Blocks, buckets and shards bound the memory of a task; a shard beyond `induced.MEMORY`
works on disk.

Defined results: a null text is empty; shorter texts lose nothing; repeated rows are equal
texts and remove each other; null ids are rows like any other; only the id column is kept.
`kept` may end inside a character, so it is binary; `whole` takes characters as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from scoreloom.llm import induced, packed

LENGTH, GRAM = 200, 80
BLOCK_BYTES = 1 << 20
PART = 1 << 18  #: windows that are hashed at a time
BUCKET_BYTES = 4 << 20
SORT_BYTES = 1 << 20
HOT = 3_000
ALONE, REPEATED, COMPARE, SINGLY = 0, 1, 2, 3
TAKES_PART = 4  #: flag: this entry's span goes to the shard
_U = np.uint64

_BLOCK = (
    "block long, bucket int, docs array<long>, offsets binary, data binary, starts binary, sizes binary, entries binary, "
    "one binary, grams binary, spans binary, counts binary"
)
_ASK = "block long, bucket int, grams binary, spans binary, counts binary"
_TOLD = "block long, bucket int, told binary, windows binary"
_SHARD = "block long, bucket int, at binary, lengths binary, told binary, grams binary, data binary, hashes binary"


def _frame(columns: dict, schema: str, n: int) -> pa.RecordBatch:
    """A batch with the columns of the schema; the others are null."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split(" ") for f in schema.split(", ")]
    arrays = [pa.nulls(n, kinds[k]) if columns.get(c) is None else pa.array(columns[c], kinds[k]) for c, k in fields]
    return pa.record_batch(arrays, names=[c for c, _ in fields])


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM, part: int | None = None):
    """Start, number of windows, anchor gram and span hash of each run of windows with one anchor.

    Works on `part` windows at a time, so that a very long text takes no more memory than a
    part; a run that a part's end cuts is two runs, whose windows meet all others as before.
    """
    part, found = part or PART, []
    for at in range(0, len(data), part):
        # Rows with windows that start in this part.
        low = max(0, int(np.searchsorted(offsets, at, "right")) - 1)
        high = min(int(np.searchsorted(offsets, at + part)), len(offsets) - 1)
        first = np.maximum(offsets[low:high], at) - at
        stop = np.minimum(offsets[low + 1 : high + 1] - length + 1, at + part) - at
        able = stop > first
        if able.any():
            starts, *rest = _runs(data[at : at + part + length - 1], first[able], stop[able], length, gram)
            found.append((starts + at, *rest))
    if not found:
        none = np.zeros(0, np.uint64)
        return none.astype(np.int64), none.astype(np.int64), none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def _runs(data: np.ndarray, first: np.ndarray, stop: np.ndarray, length: int, gram: int):
    """The runs of the windows that start at first[i] to stop[i] - 1."""
    n = len(data)
    sums, down = packed.byte_sums(data)
    grams = packed.mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    # The least gram, leftmost of equals: its place stands in the low bits.
    bits = _U(int(n).bit_length())
    grams_at = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    width = length - gram + 1
    padded = np.concatenate([grams_at, np.full(-len(grams_at) % width, ~_U(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    m = n - length + 1
    anchor = (np.minimum(behind[:m], ahead[width - 1 : width - 1 + m]) & ((_U(1) << bits) - _U(1))).astype(np.int64)
    windows = packed.ragged(first, stop - first)
    new = np.ones(len(windows), bool)
    new[1:] = anchor[windows[1:]] != anchor[windows[:-1]]
    new[(np.cumsum(stop - first) - (stop - first))] = True
    at = np.flatnonzero(new)
    sizes = np.diff(np.append(at, len(windows)))
    starts = windows[at]
    spans = packed.span_hash((sums, down), starts, starts + sizes + length - 1)
    # Least hashes are small numbers: mixed again, they spread over all buckets.
    return starts, sizes, packed.mix(grams[anchor[starts]]), packed.mix(spans + (anchor[starts] - starts).astype(np.uint64))


def _split(buckets: int):
    def split(batches):
        for block, rows in packed.blocks(batches, "text", BLOCK_BYTES):
            data, offsets = packed.text_bytes(rows.column("text"))
            starts, sizes, grams, spans = runs_of(data, offsets)
            order = np.lexsort((spans, grams))
            new = np.ones(len(order), bool)
            new[1:] = (grams[order][1:] != grams[order][:-1]) | (spans[order][1:] != spans[order][:-1])
            entry = np.empty(len(order), np.uint32)
            entry[order] = np.cumsum(new) - 1
            one = order[new]  # a run of each entry
            counts = np.minimum(np.bincount(entry, minlength=len(one)), 2).astype(np.uint8)
            yield _frame({
                "block": [block], "docs": [rows.column("doc_id").to_pylist()], "offsets": [packed.pack(np.diff(offsets), np.uint32)],
                "data": [packed.pack(data)], "starts": [packed.pack(np.diff(starts, prepend=0), np.uint32)],
                "sizes": [packed.pack(sizes, np.uint32)], "entries": [packed.pack(entry)], "one": [packed.pack(one, np.uint32)],
            }, _BLOCK, 1)
            grams, spans = grams[one], spans[one]
            asked = list(packed.bucket_ranges(grams, buckets))
            yield _frame({
                "block": [block] * len(asked), "bucket": [b for b, _ in asked], "grams": [packed.pack_sorted(grams[s]) for _, s in asked],
                "spans": [packed.pack(spans[s]) for _, s in asked], "counts": [packed.pack(counts[s]) for _, s in asked],
            }, _BLOCK, len(asked))

    return split


def _asked(batches):
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column("bucket")))
        yield batch.select(["block", "bucket", "grams", "spans", "counts"])


def _tell(table: pa.Table) -> pa.Table:
    """What the runs of a bucket's grams are, over all blocks."""
    grams = [packed.unpack_sorted(x) for x in table.column("grams").to_pylist()]
    bounds = np.cumsum([0, *map(len, grams)])
    grams = np.concatenate(grams)
    spans = np.concatenate([packed.unpack(x, np.uint64) for x in table.column("spans").to_pylist()])
    counts = np.concatenate([packed.unpack(x, np.uint8) for x in table.column("counts").to_pylist()])
    order = np.lexsort((spans, grams))
    new_gram, new_span = np.ones(len(order), bool), np.ones(len(order), bool)
    new_gram[1:] = grams[order][1:] != grams[order][:-1]
    new_span[1:] = new_gram[1:] | (spans[order][1:] != spans[order][:-1])
    span, gram = np.cumsum(new_span) - 1, np.cumsum(new_gram) - 1
    total = np.bincount(span, weights=counts[order])[span]
    variants = np.bincount(gram, weights=new_span)[gram]
    told = np.where(total > 1, REPEATED, np.where(variants > HOT, SINGLY, np.where(variants > 1, COMPARE, ALONE)))
    told = told + np.where((variants > 1) & new_span, TAKES_PART, 0) + np.where((variants > HOT) & (told == REPEATED), 8, 0)
    out = np.empty(len(order), np.uint8)
    out[order] = told
    return pa.Table.from_batches([_frame({
        "block": table.column("block").to_pylist(), "bucket": table.column("bucket").to_pylist(),
        "told": [packed.pack(out[a:b]) for a, b in zip(bounds, bounds[1:])],
    }, _TOLD, table.num_rows)])


def _own(table: pa.Table) -> dict:
    table = table.filter(pc.is_null(table.column("bucket")))
    row = {c: table.column(c)[0].as_py() for c in table.column_names}
    return row | {
        "offsets": np.concatenate([[0], np.cumsum(packed.unpack(row["offsets"], np.uint32), dtype=np.int64)]),
        "data": packed.unpack(row["data"], np.uint8), "starts": np.cumsum(packed.unpack(row["starts"], np.uint32), dtype=np.int64),
        "sizes": packed.unpack(row["sizes"], np.uint32).astype(np.int64), "entries": packed.unpack(row["entries"], np.uint32),
        "one": packed.unpack(row["one"], np.uint32),
    }


def _asks(table: pa.Table) -> list[tuple[int, int]]:
    """Buckets that the block asked, in order, with the number of entries."""
    table = table.filter(pc.is_valid(table.column("bucket")))
    rows = sorted(zip(table.column("bucket").to_pylist(), table.column("counts").to_pylist()))
    return [(b, len(packed.unpack(c, np.uint8))) for b, c in rows]


def _told(told: pa.Table) -> np.ndarray:
    told = told.filter(pc.is_valid(told.column("told"))).sort_by("bucket")
    return np.concatenate([np.zeros(0, np.uint8), *[packed.unpack(x, np.uint8) for x in told.column("told").to_pylist()]])


def _send(buckets: int):
    def send(own: pa.Table, told: pa.Table) -> pa.Table:
        row, told_all, out, at = _own(own), _told(told), [], 0
        messages = own.filter(pc.is_valid(own.column("bucket"))).sort_by("bucket").column("grams").to_pylist()
        grams = np.concatenate([np.zeros(0, np.uint64), *[packed.unpack_sorted(x) for x in messages]])
        single = {}
        for bucket, n in _asks(own):
            told_here = told_all[at : at + n]
            chosen = np.flatnonzero(told_here & TAKES_PART)
            alone = (told_here[chosen] & 3 == SINGLY) | (told_here[chosen] & 8 > 0)
            entries, hot = at + chosen[~alone], at + chosen[alone]
            if len(entries):
                runs = row["one"][entries]
                lengths = row["sizes"][runs] + LENGTH - 1
                text = row["data"][packed.ragged(row["starts"][runs], lengths)]
                out.append((row["block"], bucket, packed.pack(entries, np.uint32), packed.pack(lengths, np.uint32), packed.pack(told_all[entries]), packed.pack(grams[entries]), packed.pack(text), None))
            if len(hot):
                runs = row["one"][hot]
                sizes = row["sizes"][runs]
                lengths = sizes + LENGTH - 1
                text = row["data"][packed.ragged(row["starts"][runs], lengths)]
                begin = packed.ragged(np.cumsum(lengths) - lengths, sizes)
                hashes = packed.span_hash(packed.byte_sums(text), begin, begin + LENGTH)
                of = np.repeat(hot, sizes)
                place = packed.ragged(np.zeros(len(sizes), np.int64), sizes)
                where = packed.bucket_of(hashes, buckets)
                for b in np.unique(where).tolist():
                    single.setdefault(b, []).append((hashes[where == b], of[where == b], place[where == b]))
            at += n
        for b, found in single.items():
            hashes, of, place = (np.concatenate(x) for x in zip(*found))
            out.append((row["block"], b, packed.pack(of, np.uint32), packed.pack(place, np.uint32), packed.pack(told_all[of]), None, None, packed.pack(hashes)))
        names = ["block", "bucket", "at", "lengths", "told", "grams", "data", "hashes"]
        columns = list(zip(*out)) if out else [[]] * 8
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 6]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return send


def _parts(grams: np.ndarray, lengths: np.ndarray):
    """Slices of strings in order of their grams, cut between grams, of about `SORT_BYTES` or one gram."""
    last = np.flatnonzero(np.append(grams[1:] != grams[:-1], True)) + 1
    ends, start = np.cumsum(lengths), 0
    while start < len(grams):
        before = ends[start - 1] if start else 0
        fit = last[(last > start) & (ends[last - 1] - before <= SORT_BYTES)]
        stop = int(fit[-1]) if len(fit) else int(last[last > start][0])
        yield slice(start, stop)
        start = stop


def _compare(table: pa.Table) -> pa.Table:
    """Which windows of a shard's spans are repeated: (entry, window) pairs for each block."""
    out = []
    strings = [r for r in table.drop(["hashes"]).to_pylist() if r["data"] is not None]
    if strings:
        column = lambda c, kind: np.concatenate([packed.unpack(r[c], kind) for r in strings])
        lengths, told, entry = column("lengths", np.uint32).astype(np.int64), column("told", np.uint8), column("at", np.uint32)
        data, starts = column("data", np.uint8), np.cumsum(lengths) - lengths
        bounds = np.cumsum([0, *[len(packed.unpack(r["at"], np.uint32)) for r in strings]])
        grams = column("grams", np.uint64)
        order = np.argsort(grams, kind="stable")
        hits = []
        for part in _parts(grams[order], lengths[order]):
            chosen = order[part]
            n = lengths[chosen]
            begins = np.cumsum(n + 1) - n - 1
            text = np.zeros(int((n + 1).sum()), np.uint8)
            # No byte of UTF-8 text is 255, so that a shift by one frees 0 for the ends.
            text[packed.ragged(begins, n)] = data[packed.ragged(starts[chosen], n)] + np.uint8(1)
            found = induced.repeated_starts(text, LENGTH)
            use = np.flatnonzero(told[chosen] & 3 == COMPARE)
            sizes = n[use] - LENGTH + 1
            windows = packed.ragged(begins[use], sizes)
            hit = found[windows]
            hits.append(np.stack([np.repeat(chosen[use], sizes)[hit], (windows - np.repeat(begins[use], sizes))[hit]]))
        string, place = np.concatenate(hits, axis=1)
        order = np.argsort(string, kind="stable")
        string, place = string[order], place[order]
        cuts = np.searchsorted(string, bounds)
        for r, a, b in zip(strings, cuts, cuts[1:]):
            if b > a:
                out.append((r["block"], r["bucket"], entry[string[a:b]], place[a:b]))
    singles = [r for r in table.to_pylist() if r["hashes"] is not None]
    if singles:
        hashes = [packed.unpack(r["hashes"], np.uint64) for r in singles]
        bounds = np.cumsum([0, *map(len, hashes)])
        _, which, seen = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        for r, a, b in zip(singles, bounds, bounds[1:]):
            hit = (seen[which[a:b]] > 1) & (packed.unpack(r["told"], np.uint8) & 3 == SINGLY)
            out.append((r["block"], r["bucket"], packed.unpack(r["at"], np.uint32)[hit], packed.unpack(r["lengths"], np.uint32)[hit]))
    windows = [packed.pack(np.stack([np.asarray(e, np.uint32), np.asarray(p, np.uint32)])) for _, _, e, p in out]
    return pa.Table.from_batches([_frame({"block": [x[0] for x in out], "bucket": [x[1] for x in out], "windows": windows}, _TOLD, len(out))])


def _whole_characters(data: np.ndarray, offsets: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """`covered` with every character whole that a covered byte belongs to."""
    if not covered.any():
        return covered
    first = data & 0xC0 != 0x80
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    character = np.cumsum(first, dtype=np.int32)
    gone = np.zeros(int(character[-1]) + 1, bool)
    gone[character[covered]] = True
    return gone[character]


def _text_hash(data: np.ndarray) -> int:
    """What `xxhash64` of Spark gives the whole text."""
    return xxhash.xxh64_intdigest(data.tobytes(), 42)


def _cut(whole: bool):
    def cut(own: pa.Table, told: pa.Table) -> pa.Table:
        row = _own(own)
        data, offsets = row["data"], row["offsets"]
        repeated = _told(told) & 3 == REPEATED
        change = np.zeros(len(data) + 1, np.int32)
        complete = repeated[row["entries"]]
        np.add.at(change, row["starts"][complete], 1)
        np.add.at(change, (row["starts"] + row["sizes"])[complete] + LENGTH - 1, -1)
        found = told.filter(pc.is_valid(told.column("windows")))
        for value in found.column("windows").to_pylist():
            entry, place = packed.unpack(value, np.uint32).reshape(2, -1).astype(np.int64)
            start = row["starts"][row["one"][entry]] + place
            np.add.at(change, start, 1)
            np.add.at(change, start + LENGTH, -1)
        covered = np.cumsum(change, out=change)[:-1] > 0
        if whole:
            covered = _whole_characters(data, offsets, covered)
        edge = covered.copy()
        edge[1:] &= ~covered[:-1]
        edge[offsets[:-1][offsets[:-1] < len(data)]] = covered[offsets[:-1][offsets[:-1] < len(data)]]
        count = lambda mask: np.diff(np.append(np.int32(0), np.cumsum(mask, dtype=np.int32))[offsets]).astype(np.int64)
        removed = count(covered)
        bounds = np.concatenate([[0], np.cumsum(np.diff(offsets) - removed)])
        flat = data[~covered].tobytes()
        return pa.table({
            "doc_id": pa.array(row["docs"], pa.int64()), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(count(edge), pa.int64()),
            "kept": pa.array([flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary()),
            "text_hash": pa.array(np.array([_text_hash(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], _U).view(np.int64)),
        })

    return cut


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans`, the `kept` bytes and the `text_hash` of every row.

    With `whole`, a character of which a byte is covered goes as a whole, so that `kept` is
    UTF-8 text again and no other character is touched.
    """
    plain = docs.selectExpr(f"cast(`{id_column}` as bigint) AS doc_id", f"`{text}` AS text")
    buckets = packed.parts(packed.text_size(plain), BUCKET_BYTES)
    split = plain.mapInArrow(_split(buckets), _BLOCK).repartition(buckets, "block")
    asked = split.mapInArrow(_asked, _ASK).repartition(buckets, "bucket")
    told = asked.groupBy("bucket").applyInArrow(_tell, _TOLD).repartition(buckets, "block")
    sent = split.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_send(buckets), _SHARD)
    found = sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_compare, _TOLD)
    answers = told.unionByName(found)
    return split.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _cut(whole), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, text_hash long"
    )
