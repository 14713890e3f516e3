"""N-gram Jaccard join by PartEnum signatures.

Texts are sets of word shingles; two link when 100 |A and B| >= 75 |A or B|. Linked sets
differ in at most (|A| + |B|) / 7 shingles. PartEnum turns that bound into equality:

* sets are put into families by size (each holds sizes up to u, twice the last u; a set
  in the top quarter also enters the next family, so linked sets always share a family);
* a family cuts the shingle domain by hash into n1 partitions of three sub-partitions; of
  n1 partitions one differs in at most one shingle (if k < 2 n1), so two of its three
  sub-partitions are equal. Every set has one signature for each pair of sub-partitions.

Empty pairs of sub-partitions are equal in unrelated sets. A set whose partitions with
all pairs filled number over k / 2 needs no empty signatures, for by the same argument one
of those is shared; the few sets below that also emit their empty ones. No pair is lost.
The same holds with "filled" read as "holds a shingle that is not common": signatures of
common shingles alone leave only sets that have too few others. The common shingles are the
`COMMON` most frequent of those that blocks see in several sets; the choice cannot change a link.

Plan. Equal sets count as one set, named by its hash, and leave a block of texts once. A
block sends its signatures in messages to hash buckets. A bucket takes all pairs of a
signature that at most `SMALL` sets share. A bigger group is a star: all its sets are
paired with the smallest, the leader, so that a group of near copies costs its size, not
its square. Pairs are ruled out by an exact bound on sketches, and the rest verified on whole
texts. Verified members of a star are in their leader's component. The others, and the members
of stars with a half-similar set (by the triangle inequality of the Jaccard distance only these
can still matter), go into the next round. After `STAR_ROUNDS` the open sets meet by prefixes: of
shingles ordered from rare to common among the open sets, linked sets share one within their first quarters,
at places that leave enough shingles behind them (`open_pairs`). What sets of a family have in common is
common, so sets that are alike but not linked rarely meet. Sets of one component make no pair.
A group of such a shingle goes out in pieces of at most twice `PIECE` sets, dealt over all tasks, with
folded sketches that rule pairs out before they are written.

Defined results: a text without words has no shingles and links with nothing; with fewer
than five words the whole sequence is its one shingle; rows of a null id count, but link
with nothing and have no component; repeated rows each return a row.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import packed
from scoreloom.llm.components import smallest_member
from scoreloom.session import work_path

SHINGLE = 5
BLOCK_BYTES = 3 << 20
BUCKET_BYTES = 6 << 20
PACKED_BYTES, COMPARED_BYTES = 1 << 20, 1 << 17  #: of packed texts, about a third of their size
STAR_ROUNDS = 1
SMALL = 8
COMMON, COMMON_IN_BLOCK = 100_000, 3
SKETCH_BITS, MOST_SKETCH_BITS = 1024, 1 << 15  #: a sketch has a bit per shingle, between these
PIECE = 512
MEETING_BYTES = 32  #: of the folded sketches that rule pairs of open sets out where they meet
MOST_NAMES = 2_000_000  #: names of sets, of 8 bytes, that are broadcast to find their texts; more are joined
RARITY_BITS = 20  #: shingles are counted in so many classes; any counts give the same links
_U = np.uint64
_ODD = (_U(0xD1342543DE82EF95), _U(0xAF251AF3B0F025B5), _U(0xB564EF22EC7AECE5))


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text."""
    words, bounds = packed.hashed_words(column)
    n = max(0, len(words) - SHINGLE + 1)
    with np.errstate(over="ignore"):
        run = np.full(n, _U(SHINGLE))
        for j in range(SHINGLE):
            run = packed.mix(run * _ODD[0] + words[j : j + n])
        sets = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= SHINGLE:
                sets.append(np.unique(run[a : b - SHINGLE + 1]))
                continue
            own = np.full(min(1, b - a), _U(b - a))
            for j in range(a, b):
                own = packed.mix(own * _ODD[0] + words[j])
            sets.append(own)
    return sets


def set_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit name per set, the same for equal sets; 0 for the empty set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = packed.mix(np.concatenate(sets)) if len(sets) else np.zeros(0, np.uint64)
    ends = np.concatenate([np.zeros(1, np.uint64), np.cumsum(flat, dtype=np.uint64)])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    with np.errstate(over="ignore"):
        return packed.mix(ends[bounds[1:]] - ends[bounds[:-1]] + packed.mix(sizes.astype(np.uint64)))


def _family(sizes: np.ndarray) -> np.ndarray:
    """Number of the family whose largest size u = 8 * 2^j is the first to hold each set."""
    return np.maximum(0, np.ceil(np.log2(np.maximum(sizes, 1) / 8)).astype(np.int64))


def signatures(sets: list[np.ndarray], common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Signatures, and the index of the set that each belongs to. Sets under three
    shingles have none: they link with equal sets only. `common` are ascending shingles;
    any choice gives the same links, if it is the same for all sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    home = _family(sizes)
    able = np.flatnonzero(sizes >= 3)
    twice = able[4 * sizes[able] > 3 * (8 << home[able])]  # may link into the next family
    owner, family = np.concatenate([able, twice]), np.concatenate([home[able], home[twice] + 1])
    if not len(owner):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    partitions = -(-(8 << family) // 6)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(sets)
    rare = np.ones(len(flat), bool)
    if common is not None and len(common):
        rare = common[np.minimum(np.searchsorted(common, flat), len(common) - 1)] != flat
    take = packed.ragged(bounds[owner], sizes[owner])
    shingle = packed.mix(flat[take] + _ODD[1])
    cells = 3 * partitions
    first = np.cumsum(cells) - cells
    cell = ((shingle >> _U(32)) * np.repeat(cells, sizes[owner]).astype(np.uint64)) >> _U(32)
    cell = cell.astype(np.int64) + np.repeat(first, sizes[owner])
    total = int(cells.sum())
    sums = np.zeros(total, np.uint64)
    np.add.at(sums, cell, packed.mix(shingle))
    sums = sums.reshape(-1, 3)
    most = (sizes[owner] + 4 * sizes[owner] // 3) // 7
    place = np.arange(total // 3) - np.repeat(first // 3, partitions)
    spot = packed.mix((np.repeat(family, partitions) << 40 | place).astype(np.uint64))
    of = np.repeat(owner, partitions)

    def told(filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sub-partitions that are filled, and rows of sets with too few good partitions."""
        filled = (np.bincount(cell[filled], minlength=total) > 0).reshape(-1, 3)
        good = np.add.reduceat((filled.sum(1) >= 2).astype(np.int64), first // 3)
        return filled, np.repeat(2 * good <= most, partitions)

    by_rare, few_rare = told(rare[take])
    by_any, few_any = told(np.ones(len(take), bool))
    keys, owners = [], []
    for a, b in ((0, 1), (0, 2), (1, 2)):
        use = by_rare[:, a] | by_rare[:, b] | (few_rare & (by_any[:, a] | by_any[:, b] | few_any))
        key = sums[use, a] * _ODD[a] + sums[use, b] * _ODD[b] + spot[use] + _U(3 * a + b)
        keys.append(packed.mix(key))
        owners.append(of[use])
    return np.concatenate(keys), np.concatenate(owners)


def _ties(keys: np.ndarray, names: np.ndarray, labels: np.ndarray, small: int) -> np.ndarray:
    """Rows (a, b, big) of the sets that share a signature: all pairs of groups of at most
    `small` sets; of bigger groups the pairs with the smallest set, marked big. Sets of
    one label are connected already and make no pair."""
    order = np.lexsort((names, keys))
    keys, names, labels = keys[order], names[order], labels[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
    keys, names, labels = keys[new], names[new], labels[new]
    start = np.ones(len(keys), bool)
    start[1:] = keys[1:] != keys[:-1]
    group = np.cumsum(start) - 1
    size = np.bincount(group)[group] if len(keys) else group
    big = size > small
    leader = names[start][group] if len(keys) else names
    member = big & ~start
    out = [np.stack([leader[member], names[member], np.ones(int(member.sum()), np.uint64)], 1)]
    few = np.flatnonzero(~big)
    for step in range(1, int(size[few].max()) if len(few) else 0):
        at = few[few + step < len(keys)]
        few = at = at[group[at + step] == group[at]]
        at = at[labels[at + step] != labels[at]]
        out.append(np.unique(np.stack([names[at], names[at + step], np.zeros(len(at), np.uint64)], 1), axis=0))
    return np.unique(np.concatenate(out), axis=0)


_ASK = "bucket int, keys binary, owners binary, names binary, labels binary"


def _signature_messages(buckets: int, common: np.ndarray):
    def send(batches):
        for _, rows in packed.blocks(batches, "text", BLOCK_BYTES):
            sets = shingle_sets(_plain(rows.column("text")))
            names = set_hashes(sets)
            _, one = np.unique(names, return_index=True)
            sets, names = [sets[i] for i in one], names[one]
            labels = rows.column("label").to_numpy(zero_copy_only=False)[one] if "label" in rows.schema.names else None
            keys, owners = signatures(sets, common)
            order = np.argsort(keys)
            keys, owners = keys[order], owners[order]
            out = []
            for bucket, s in packed.bucket_ranges(keys, buckets):
                used, local = np.unique(owners[s], return_inverse=True)
                kind = np.uint16 if len(used) < 1 << 16 else np.uint32
                out.append((bucket, packed.pack_sorted(keys[s]), bytes([np.dtype(kind).itemsize]) + packed.pack(local, kind), packed.pack(names[used]), None if labels is None else packed.pack(labels[used])))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.record_batch(
                [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=["bucket", "keys", "owners", "names", "labels"]
            )

    return send


def _meet(small: int):
    def meet(table: pa.Table) -> pa.Table:
        """Sets of one bucket's signatures over all blocks."""
        keys, names, labels = [], [], []
        for r in table.to_pylist():
            keys.append(packed.unpack_sorted(r["keys"]))
            local = packed.unpack(r["owners"][1:], np.uint16 if r["owners"][0] == 2 else np.uint32)
            names.append(packed.unpack(r["names"], np.uint64)[local])
            labels.append(names[-1] if r["labels"] is None else packed.unpack(r["labels"], np.uint64)[local])
        keys, names, labels = np.concatenate(keys), np.concatenate(names), np.concatenate(labels)
        order = np.argsort(keys, kind="stable")
        equal = keys[order][1:] == keys[order][:-1]
        same = np.zeros(len(keys), bool)
        same[order[1:]] |= equal
        same[order[:-1]] |= equal
        pairs = _ties(keys[same], names[same], labels[same], small)
        return pa.table({"a": pairs[:, 0].copy().view(np.int64), "b": pairs[:, 1].copy().view(np.int64), "big": pairs[:, 2] > 0})

    return meet


def _plain(column: pa.Array) -> pa.Array:
    """Texts, unpacked if they are stored packed."""
    if pa.types.is_binary(column.type):
        unpack = zstandard.ZstdDecompressor().decompress
        return pa.array([unpack(x) for x in column.to_pylist()], pa.binary()).cast(pa.string())
    return column


def candidates(texts: DataFrame, buckets: int, common: np.ndarray, small: int = SMALL) -> DataFrame:
    """Distinct (a, b, big) of sets that share a signature; `big` if in a star of many sets."""
    asked = texts.select(*[c for c in ("text", "label") if c in texts.columns]).mapInArrow(_signature_messages(buckets, common), _ASK)
    met = asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_meet(small), "a long, b long, big boolean")
    return met.groupBy("a", "b").agg(F.max("big").alias("big"))


def _classes(shingles: np.ndarray) -> np.ndarray:
    return (packed.mix(shingles + _ODD[0]) >> _U(64 - RARITY_BITS)).astype(np.int64)


def _rarity(batches):
    for _, rows in packed.blocks(batches, "text", PACKED_BYTES):
        sets = shingle_sets(_plain(rows.column("text")))
        kinds, n = np.unique(_classes(np.concatenate(sets)), return_counts=True)
        yield pa.record_batch({"kind": pa.array(kinds, pa.int32()), "n": pa.array(n, pa.int64())})


def _prefix_messages(buckets: int, counts: np.ndarray):
    """The first shingles of each set from rare to common, with their places."""

    def send(batches):
        for _, rows in packed.blocks(batches, "text", PACKED_BYTES):
            sets = shingle_sets(_plain(rows.column("text")))
            names = rows.column("name").to_numpy().view(np.uint64)
            labels = rows.column("label").to_numpy().view(np.uint64)
            sizes = np.array([len(x) for x in sets], np.int64)
            short = np.concatenate([folded(x[None], MEETING_BYTES) for x in sketches(sets)])
            flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.lexsort((flat, counts[_classes(flat)], owner))
            # Linked sets share 3/4 of either, so one of the first n - ceil(3 n / 4) + 1.
            first = sizes - (3 * sizes + 3) // 4 + 1
            at = order[packed.ragged(np.cumsum(sizes) - sizes, first)]
            keys, owners, places = flat[at], owner[at], packed.ragged(np.zeros(len(sets), np.int64), first)
            keys = packed.mix(keys + _ODD[1])
            order = np.argsort(keys)
            keys, owners, places = keys[order], owners[order], places[order]
            out = []
            for bucket, s in packed.bucket_ranges(keys, buckets):
                used, local = np.unique(owners[s], return_inverse=True)
                of_sets = [packed.pack(x[used]) for x in (names, labels, sizes)]
                of_keys = packed.pack_sorted(keys[s]), packed.pack(local, np.uint32), packed.pack(places[s], np.uint32)
                out.append((bucket, *of_keys, *of_sets, short[used].tobytes()))
            columns = list(zip(*out)) if out else [[]] * 8
            yield pa.record_batch([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=_PREFIXES)

    return send


_PREFIXES = ["bucket", "keys", "owners", "places", "names", "labels", "sizes", "sketches"]
_PIECES = "across int, groups binary, names binary, labels binary, sizes binary, places binary, members binary, sketches binary"


def _pieces(table: pa.Table) -> pa.Table:
    """Groups of one shingle: small ones together, big ones cut into parts and each two parts.

    `across` is the number of sets of the first part, or 0 where a piece is paired within its groups.
    """
    parts, seen = [], 0
    short = np.concatenate([_short(x) for x in table.column("sketches").to_pylist()])
    for r in table.to_pylist():
        local = packed.unpack(r["owners"], np.uint32)
        row, seen = seen + local, seen + len(r["sketches"]) // MEETING_BYTES
        of_sets = [packed.unpack(r[c], kind)[local] for c, kind in (("names", np.uint64), ("labels", np.uint64), ("sizes", np.int64))]
        parts.append((packed.unpack_sorted(r["keys"]), *of_sets, packed.unpack(r["places"], np.uint32), row))
    keys, names, labels, sizes, places, row = map(np.concatenate, zip(*parts))
    order = np.lexsort((names, sizes, labels, keys))
    keys, names, labels, sizes, places, row = (x[order] for x in (keys, names, labels, sizes, places, row))
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    length = np.diff(np.append(start, len(keys)))
    groups = np.repeat(np.arange(len(start)), length)
    out = []

    def put(at: np.ndarray, across: int):
        of_sets = [packed.pack(x[at]) for x in (names, labels, sizes)]
        of_rows, members = np.unique(row[at], return_inverse=True)  # each sketch goes out once in a piece
        out.append((across, packed.pack(groups[at], np.uint32), *of_sets, packed.pack(places[at], np.uint32), packed.pack(members, np.uint16), short[of_rows].tobytes()))

    few = np.flatnonzero((length > 1) & (length <= PIECE))
    ends, a = np.cumsum(length[few]), 0
    while a < len(few):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PIECE, "right")))
        put(packed.ragged(start[few[a:b]], length[few[a:b]]), 0)
        a = b
    for g in np.flatnonzero(length > PIECE):
        cut = [np.arange(x, min(x + PIECE, start[g] + length[g])) for x in range(start[g], start[g] + length[g], PIECE)]
        span = [(sizes[x].min(), sizes[x].max(), labels[x[0]], labels[x[-1]]) for x in cut]  # in order of labels
        for i, (least, most, low, high) in enumerate(span):
            for j in range(i, len(cut)):
                if low == span[j][3] or 4 * most < 3 * span[j][0] or 4 * span[j][1] < 3 * least:
                    continue  # one component, or no two sets of like size
                put(cut[i] if i == j else np.concatenate([cut[i], cut[j]]), 0 if i == j else len(cut[i]))
    columns = list(zip(*out)) if out else [[]] * 8
    kinds = [pa.int32(), *[pa.binary()] * 7]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in _PIECES.split(", ")])


def _short(sketch: bytes) -> np.ndarray:
    return np.frombuffer(sketch, np.uint8).reshape(-1, MEETING_BYTES)


def _pairs_of_pieces(batches):
    for batch in batches:
        for r in batch.to_pylist():
            names, labels = packed.unpack(r["names"], np.uint64), packed.unpack(r["labels"], np.uint64)
            sizes, places = packed.unpack(r["sizes"], np.int64), packed.unpack(r["places"], np.uint32).astype(np.int64)
            groups, n = packed.unpack(r["groups"], np.uint32), len(names)
            short = _short(r["sketches"])[packed.unpack(r["members"], np.uint16)].view(np.uint64)
            few = np.arange(n)
            for step in range(1, n):
                few = few[few + step < n]
                x, y = few, few + step
                if r["across"]:
                    use = (x < r["across"]) & (y >= r["across"])
                else:
                    x = few = few[groups[few] == groups[few + step]]
                    y, use = x + step, np.ones(len(x), bool)
                    if not len(x):
                        break
                # At the first shingle that linked sets share, both have enough left.
                left = np.minimum(sizes[x] - places[x], sizes[y] - places[y])
                use &= (labels[x] != labels[y]) & (7 * left >= 3 * (sizes[x] + sizes[y]))
                x, y = x[use], y[use]
                use = 7 * np.bitwise_count(short[x] ^ short[y]).sum(1, dtype=np.int64) <= sizes[x] + sizes[y]
                if use.any():
                    a, b = np.minimum(names[x[use]], names[y[use]]), np.maximum(names[x[use]], names[y[use]])
                    yield pa.record_batch({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64)), "big": pa.array(np.zeros(len(a), bool))})


def open_pairs(texts: DataFrame, buckets: int) -> DataFrame:
    """Distinct (a, b, big) of sets of different labels, with every pair that links; none is big."""
    kinds = texts.select("text").mapInArrow(_rarity, "kind int, n long").groupBy("kind").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << RARITY_BITS, np.int64)
    counts[kinds.column("kind").to_numpy()] = kinds.column("n").to_numpy()
    asked = texts.select("name", "text", "label").mapInArrow(_prefix_messages(buckets, counts), f"bucket int, {' binary, '.join(_PREFIXES[1:])} binary")
    pieces = asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_pieces, _PIECES)
    pairs = pieces.repartition(buckets).mapInArrow(_pairs_of_pieces, "a long, b long, big boolean")
    return pairs.distinct()


def _rows(batches):
    """Name and size of each row's set, and once per block the shingles of several of its sets."""
    for _, rows in packed.blocks(batches, "text", BLOCK_BYTES):
        sets = shingle_sets(rows.column("text"))
        names = set_hashes(sets)
        _, one = np.unique(names, return_index=True)
        keys, counts = np.unique(np.concatenate([sets[i] for i in one]), return_counts=True)
        often = counts >= COMMON_IN_BLOCK
        blank = [None] * (len(sets) - 1)
        yield pa.record_batch({
            "doc_id": rows.column("doc_id"), "name": pa.array(names.view(np.int64)), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "sketch": pa.array([x.tobytes() for x in sketches(sets)], pa.binary()),
            "often": pa.array([packed.pack(keys[often]), *blank], pa.binary()), "counts": pa.array([packed.pack(counts[often], np.uint32), *blank], pa.binary()),
        })


def _unpacked(batches):
    for batch in batches:
        for keys, counts in zip(batch.column("often").to_pylist(), batch.column("counts").to_pylist()):
            yield pa.record_batch({"key": pa.array(packed.unpack(keys, np.int64)), "n": pa.array(packed.unpack(counts, np.uint32), pa.int64())})


def common_shingles(rows: DataFrame) -> np.ndarray:
    """At most `COMMON` shingles (8 bytes each), ascending."""
    seen = rows.where("often IS NOT NULL").select("often", "counts").mapInArrow(_unpacked, "key long, n long")
    top = seen.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(COMMON).select("key").toArrow()
    return np.sort(top.column("key").to_numpy().view(np.uint64))


def _texts(batches):
    """One packed text of each set of a block that can link with another."""
    compress = zstandard.ZstdCompressor(level=1).compress
    for _, rows in packed.blocks(batches, "text", BLOCK_BYTES):
        sets = shingle_sets(rows.column("text"))
        names = set_hashes(sets).view(np.int64)
        _, one = np.unique(names, return_index=True)
        one = one[[len(sets[i]) >= 3 for i in one]] if len(one) else one
        texts = rows.column("text").take(pa.array(one)).to_pylist()
        yield pa.record_batch({"name": pa.array(names[one]), "text": pa.array([compress(t.encode()) for t in texts], pa.binary())})


def _compare(batches):
    for batch in batches:
        size = lambda c: pc.binary_length(batch.column(c)).to_numpy().astype(np.int64)  # noqa: B023, E731
        for part in packed.slices(batch, size("left") + size("right"), COMPARED_BYTES):
            # Pairs come in order of a set, and leaders are in many: each text of a part is cut into words once.
            names = np.concatenate([part.column(c).to_numpy() for c in ("a", "b")])
            _, one, of = np.unique(names, return_index=True, return_inverse=True)
            texts = pa.concat_arrays([part.column("left"), part.column("right")]).take(pa.array(one))
            sets, n = shingle_sets(_plain(texts)), part.num_rows
            pairs = [(sets[x], sets[y]) for x, y in zip(of[:n], of[n:])]
            both = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in pairs]
            either = [len(x) + len(y) - n for (x, y), n in zip(pairs, both)]
            yield pa.record_batch({
                "a": part.column("a"), "b": part.column("b"), "big": part.column("big"), "shared": pa.array(both, pa.int64()), "all": pa.array(either, pa.int64()),
            })
    pa.default_memory_pool().release_unused()


def sketches(sets: list[np.ndarray]) -> list[np.ndarray]:
    """For each set the parity of its shingles in each of 2^i classes, packed; 2^i is its size or more.

    Two sets that differ in d shingles have sketches that differ in at most d bits. A sketch
    folds into a shorter one, since the classes are remainders. Sets over `MOST_SKETCH_BITS`
    have as many classes: more of their pairs are left to be compared.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    bits = 1 << np.ceil(np.log2(np.clip(sizes, SKETCH_BITS, MOST_SKETCH_BITS))).astype(np.int64)
    ends = np.cumsum(bits)
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    cell = (packed.mix(flat + _ODD[2]) & _U(MOST_SKETCH_BITS - 1)).astype(np.int64)
    cell = (cell & np.repeat(bits - 1, sizes)) + np.repeat(ends - bits, sizes)
    odd = np.zeros(int(ends[-1]) // 8 if len(sets) else 0, np.uint8)
    np.bitwise_xor.at(odd, cell >> 3, np.uint8(1) << (cell & 7).astype(np.uint8))
    return np.split(odd, ends[:-1] // 8) if len(sets) else []


def folded(sketch: np.ndarray, width: int) -> np.ndarray:
    """Rows of sketches, cut down to `width` bytes."""
    return np.bitwise_xor.reduce(sketch.reshape(len(sketch), -1, width), axis=1)


def _sift(batches):
    """How far the sketches of each pair let it be linked, or half-similar."""
    for batch in batches:
        length = [pc.binary_length(batch.column(c)).to_numpy().astype(np.int64) for c in ("s", "t")]
        both = batch.column("n").to_numpy() + batch.column("m").to_numpy()
        apart = np.zeros(len(both), np.int64)
        for x, y in np.unique(np.stack(length, 1), axis=0).tolist():
            at = np.flatnonzero((length[0] == x) & (length[1] == y))
            rows = [b"".join(batch.column(c).take(pa.array(at)).to_pylist()) for c in ("s", "t")]
            left, right = (folded(np.frombuffer(r, np.uint8).reshape(len(at), -1), min(x, y)) for r in rows)
            apart[at] = np.bitwise_count(left ^ right).sum(1, dtype=np.int64)
        yield pa.record_batch({
            "a": batch.column("a"), "b": batch.column("b"), "big": batch.column("big"), "linked": pa.array(7 * apart <= both), "half": pa.array(3 * apart <= both),
        })


def _packed_texts(docs: DataFrame, names: DataFrame, path: str) -> DataFrame:
    """(name, text) of the sets in `names`, once each, as a written table.

    The names are written and counted first: if they are few, no other text is shuffled.
    """
    names = packed.staged(names.distinct(), f"{path}-names")
    few = names.count() <= MOST_NAMES
    texts = docs.select("text").mapInArrow(_texts, "name long, text binary")
    texts = texts.join(F.broadcast(names) if few else names, "name", "left_semi")
    return packed.staged(texts.dropDuplicates(["name"]), path)


def verify(pairs: DataFrame, sketch: DataFrame, docs: DataFrame, path: str) -> DataFrame:
    """Pairs (a, b, big) with `linked` and `half`: whether their sets reach 75, and maybe 50, percent.

    Sketches rule pairs out exactly; what is left is compared on whole texts.
    """
    left = sketch.select(F.col("name").alias("a"), F.col("n").alias("n"), F.col("sketch").alias("s"))
    right = sketch.select(F.col("name").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("t"))
    sifted = pairs.join(left, "a").join(right, "b").select("a", "b", "big", "n", "m", "s", "t")
    sifted = packed.staged(sifted.mapInArrow(_sift, "a long, b long, big boolean, linked boolean, half boolean"), f"{path}-sifted")
    wanted = sifted.where("linked").select(F.explode(F.array("a", "b")).alias("name"))
    texts = _packed_texts(docs, wanted, f"{path}-texts")
    left = texts.select(F.col("name").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("name").alias("b"), F.col("text").alias("right"))
    close = sifted.where("linked").select("a", "b", "big").join(left, "a").join(right, "b").select("a", "b", "big", "left", "right")
    compared = close.mapInArrow(_compare, "a long, b long, big boolean, shared long, all long")
    compared = compared.selectExpr("a", "b", "big", "100 * shared >= 75 * all AS linked", "2 * shared >= all AS half")
    return packed.staged(compared.unionByName(sifted.where("NOT linked")), f"{path}-verified")


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _links(docs: DataFrame, path: str, common: np.ndarray, sketch: DataFrame, star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """Verified links (a, b) between set names that connect every component."""
    buckets = packed.parts(packed.text_size(docs), BUCKET_BYTES)
    found, links = candidates(docs, buckets, common), []
    for i in range(1, star_rounds + 2):
        checked = verify(packed.staged(found, f"{path}/{i}-pairs"), sketch, docs, f"{path}/{i}")
        links.append(checked.where("linked").select("a", "b"))
        star = checked.where("big")
        failed = star.where("NOT linked")
        if i > star_rounds or failed.isEmpty():
            break
        open_leaders = failed.where("half").select("a").distinct()
        active = failed.select("b").unionByName(star.where("linked").join(open_leaders, "a", "left_semi").select("b"))
        left = _packed_texts(docs, active.select(F.col("b").alias("name")), f"{path}/{i}-left")
        if i == star_rounds:  # pairs that are not connected yet
            label = smallest_member(_all(links)).select(F.col("node").alias("name"), "component")
            left = left.join(label, "name", "left").select("name", "text", F.coalesce("component", "name").alias("label"))
        found = candidates(left, buckets, common, SMALL) if i < star_rounds else open_pairs(left, buckets)
    return _all(links)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `n_shingles`, and `component_id`: the smallest id that links reach."""
    path = work_path(docs.sparkSession, "jaccard")
    plain = docs.selectExpr(f"cast(`{id_column}` as bigint) AS doc_id", f"`{text}` AS text")
    rows = plain.mapInArrow(_rows, "doc_id long, name long, n_shingles long, sketch binary, often binary, counts binary")
    rows = packed.staged(rows, f"{path}/rows")
    sketch = rows.where("n_shingles >= 3").groupBy("name").agg(F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    links = _links(plain.where("doc_id IS NOT NULL"), path, common_shingles(rows), sketch)
    # Equal sets are one node: the smallest id that has the set.
    node = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("node"))
    a, b = node.select(F.col("name").alias("a"), F.col("node").alias("x")), node.select(F.col("name").alias("b"), F.col("node").alias("y"))
    edges = links.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    component = node.join(smallest_member(edges), "node", "left").select("name", F.coalesce("component", "node").alias("component"))
    return rows.join(component, "name", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))).alias("component_id"),
    )
