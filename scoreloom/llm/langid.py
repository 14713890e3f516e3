"""Language identification by Bayesian fusion of four kinds of evidence.

For each language: log posterior = log prior of the text's host
    + log-likelihood of its letters (words' character trigrams, at most `MOST_TEXT` nats of evidence,
      as trigrams of one text are not independent)
    + log P(declared language | language) for the declared markup language
    + log P(address suffix | language) for the suffix of the address.

Host priors are smoothed hierarchically: a host's language counts lean on its domain's, and
the domain's on the whole table's. A host that is its own domain leans once, and a host whose
rows declare nothing has its domain's prior. All tables (trigrams, suffixes, hosts) are grouped aggregates
over all rows by their declared language; rows that declare none add nothing to them. How often
a declaration errs is a constant, since it cannot be learned from declarations.

A row is rejected when it has no letters, when the posterior of its language is under
`least_posterior`, or when its letters are less likely in every language than `least_fit`
nats a trigram below the table's usual (text of no known language).

Plan. Trigrams are counted in blocks (distinct ones only leave a task) and summed; every declared
language and every trigram counts. Only the pairs (language, trigram) that occur are kept: all others
have one weight per language. Up to `MOST_PAIRS` of them travel in the closure of the scoring pass,
which is one scan; beyond that the rows are stored in blocks, and the pairs come to each block by a
join on its distinct trigrams. Hosts and suffixes are joined to the rows by both, where a
hot host's rows stand on the side that adaptive execution splits.

Defined results: declared languages lose their region and script ("en-US", "en_GB" are "en"), blank ones are null; null and empty texts have no letters and are rejected; a null or unknown
declared language, host or suffix gives no evidence; repeated rows each count and each return a row;
in a table that declares no language at all everything is rejected with language null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm import packed
from scoreloom.session import work_path

MOST_PAIRS = 4_000_000  #: (language, trigram) pairs, 16 bytes each, in a closure
ENTRIES, CELLS = 4 << 20, 2 << 20  #: numbers that a task expands at once; rows by languages of a part of a block
MOST_TEXT = 50.0  #: trigrams' worth of evidence that a text gives at most
BLOCK_BYTES = 2 << 20
LEAN = 20.0  #: rows' worth of the level above in each level of the host prior
LEAST_POSTERIOR, LEAST_FIT = 0.5, 5.0

# ASCII letters fold to lower case; other characters stay; the rest parts words.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Three bytes of a word or of its edges as one number each, and the row of each."""
    data, offsets = packed.text_bytes(column)
    # A blank before each row keeps rows apart.
    n = np.diff(offsets)
    spaced = np.full(len(data) + len(n) + 1, 0x20, np.uint8)
    spaced[packed.ragged(offsets[:-1] + np.arange(len(n)) + 1, n)] = _FOLD[data]
    key = spaced[:-2].astype(np.int32) << 16 | spaced[1:-1].astype(np.int32) << 8 | spaced[2:]
    middle = spaced[1:-1] != 0x20
    row = np.searchsorted(offsets[1:] + np.arange(len(n)) + 1, np.flatnonzero(middle) + 1, "right")
    return key[middle], row


def _count(batches):
    for _, rows in packed.blocks(batches, "text", BLOCK_BYTES):
        key, row = trigrams(rows.column("text"))
        declared = rows.column("declared").to_pylist()
        names = sorted({d for d in declared if d is not None})
        place = {d: i for i, d in enumerate(names)}
        number = np.array([place.get(d, -1) for d in declared], np.int64)
        use = number[row] >= 0
        pairs, counts = np.unique(number[row][use] << 24 | key[use], return_counts=True)
        yield pa.record_batch({
            "language": pa.array([names[i] for i in (pairs >> 24).tolist()], pa.string()), "key": pa.array(pairs & 0xFFFFFF, pa.int32()),
            "n": pa.array(counts, pa.int64()),
        })


class Model:
    """Log-probabilities of trigrams: by language those of one without a pair, and how much each pair adds.

    `pairs` (key, language's number, n) may be left out, and come block by block (`having`).
    """

    def __init__(self, languages: list[str], unseen: np.ndarray, usual: float, pairs: pa.Table | None):
        self.languages, self.unseen, self.usual = languages, unseen, usual
        self.place = {x: i for i, x in enumerate(languages)}
        self.whole = pairs is not None
        if self.whole:
            keys = pairs.column("key").to_numpy()
            order = np.argsort(keys, kind="stable")
            self.keys, self.starts = np.unique(keys[order], return_index=True)
            self.starts = np.append(self.starts, len(keys))
            self.language = pairs.column("language").to_numpy()[order].astype(np.int32)
            self.adds = np.log(2.0 * pairs.column("n").to_numpy()[order] + 1.0)  # (n + 0.5) / 0.5

    def having(self, pairs: pa.Table) -> Model:
        return Model(self.languages, self.unseen, self.usual, pairs)

    def evidence(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods by row and language, and each row's number of trigrams."""
        key, row = trigrams(column)
        k, n = len(self.languages), np.bincount(row, minlength=len(column))
        logs = n[:, None] * self.unseen[None, :]
        if not len(self.keys) or not len(key):
            return logs, n
        both, times = np.unique(row << 24 | key, return_counts=True)
        row, key = both >> 24, both & 0xFFFFFF
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        row, at, times = row[known], at[known], times[known]
        sizes = self.starts[at + 1] - self.starts[at]
        ends, flat, a = np.cumsum(sizes), logs.reshape(-1), 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + ENTRIES, "right")))
            take = packed.ragged(self.starts[at[a:b]], sizes[a:b])
            cell = np.repeat((row[a:b] - row[a]) * k, sizes[a:b]) + self.language[take]
            sums = np.bincount(cell, weights=self.adds[take] * np.repeat(times[a:b], sizes[a:b]))
            flat[row[a] * k : row[a] * k + len(sums)] += sums
            a = b
        return logs, n


def _learn(rows: DataFrame, path: str) -> Model | None:
    """The model, `whole` if its pairs are few enough; all counts stand at `path`."""
    counts = rows.mapInArrow(_count, "language string, key int, n long").groupBy("language", "key").agg(F.sum("n").alias("n"))
    counts = packed.staged(counts, path)
    adds = F.sum(F.col("n") * F.log(2.0 * F.col("n") + 1.0))
    sizes = counts.groupBy("language").agg(F.sum("n").alias("n"), F.count("*").alias("pairs"), adds.alias("adds")).collect()
    if not sizes:
        return None
    sizes.sort(key=lambda r: r.language)
    total = np.array([r.n for r in sizes], float)
    kinds = counts.select("key").distinct().count() + 1
    unseen = np.log(0.5 / (total + 0.5 * kinds))
    usual = float(((total * unseen).sum() + sum(r.adds for r in sizes)) / total.sum())  # log-likelihood of a trigram of its own language
    languages = [r.language for r in sizes]
    few = sum(r.pairs for r in sizes) <= MOST_PAIRS
    return Model(languages, unseen, usual, _numbered(counts, languages).toArrow() if few else None)


def _numbered(counts: DataFrame, languages: list[str]) -> DataFrame:
    number = counts.sparkSession.createDataFrame(pa.table({"language": pa.array(languages, pa.string()), "number": pa.array(range(len(languages)), pa.int32())}))
    return counts.join(number, "language").select("key", F.col("number").alias("language"), "n")


def _fuse(totals: np.ndarray, least_posterior: float, least_fit: float):
    """totals: rows that declare each language."""
    k = len(totals)
    table = (totals + 1) / (totals.sum() + k)
    # How often a declaration errs is not learned from itself: one share for all errors.
    right, wrong = np.log(0.9), np.log(0.1 / max(k - 1, 1))

    def score(model: Model, rows: pa.RecordBatch) -> pa.RecordBatch:
        def counted(pairs) -> np.ndarray:
            n = np.zeros(k)
            for x in pairs or ():
                if x["declared"] in model.place:
                    n[model.place[x["declared"]]] = x["n"]
            return n

        def lean(pairs, above: np.ndarray) -> np.ndarray:
            """Shares of the counts, leaning on those of the level above."""
            n = counted(pairs)
            return (n + LEAN * above) / (n.sum() + LEAN)

        def prior(row) -> np.ndarray:
            return np.log(lean(row["by_host"], lean(row["by_domain"], table)))

        def ends(row) -> np.ndarray:
            n = counted(row["by_suffix"])
            return np.log((n + LEAN * 0.05) / (totals + LEAN)) if n.any() else n

        def each(of, key: str, *columns: str) -> np.ndarray:
            """`of` each row, taken once for each value of the key."""
            names, first, known = rows.column(key).to_pylist(), {}, []
            number = np.array([first.setdefault(x, len(first)) for x in names])
            _, at = np.unique(number, return_index=True)
            for row in pa.table({c: rows.column(c).take(pa.array(at)) for c in columns}).to_pylist():
                known.append(of(row))
            return np.stack(known)[number]

        text, n = model.evidence(rows.column("text"))
        best = text.max(1)
        # Trigrams overlap: beyond a point more of them say little more. What counts is how
        # many there are, so that languages unlike the text have no say in its rivals' odds.
        z = text - best[:, None]
        z *= np.minimum(1.0, MOST_TEXT / np.maximum(n, 1))[:, None]
        said = np.array([model.place.get(x, k) for x in rows.column("declared").to_pylist()], np.int64)
        told = np.flatnonzero(said < k)
        z[told] += wrong
        z[told, said[told]] += right - wrong
        z += each(prior, "host", "by_host", "by_domain")
        z += each(ends, "suffix", "by_suffix")
        p = np.exp(z - z.max(1)[:, None])
        p /= p.sum(1)[:, None]
        at = p.argmax(1)
        sure = p[np.arange(len(at)), at]
        fit = best / np.maximum(n, 1)
        kept = (n > 0) & (sure >= least_posterior) & (fit >= model.usual - least_fit)
        return pa.record_batch({
            "_row": rows.column("_row"), "language": pa.array([model.languages[i] if m else None for i, m in zip(at, n)], pa.string()),
            "posterior": pa.array(np.where(n > 0, sure, 0.0)), "fit": pa.array(np.where(n > 0, fit, 0.0)), "kept": pa.array(kept),
        })

    def parts(model: Model, rows: pa.RecordBatch):
        step = max(1, CELLS // k)
        for at in range(0, rows.num_rows, step):
            yield score(model, rows.slice(at, step))

    return parts


def _with_block(batches):
    for block, rows in packed.blocks(batches, "text", BLOCK_BYTES):
        yield rows.append_column("_block", pa.array(np.full(rows.num_rows, block), pa.int64()))


def _block_keys(batches):
    for _, rows in packed.blocks(batches, "text", BLOCK_BYTES):
        key, row = trigrams(rows.column("text"))
        blocks, place = np.unique(rows.column("_block").to_numpy(), return_inverse=True)
        both = np.unique(place[row] << 24 | key)
        yield pa.record_batch({"_block": pa.array(blocks[both >> 24], pa.int64()), "key": pa.array(both & 0xFFFFFF, pa.int32())})


def _score_joined(rows: DataFrame, counts: DataFrame, model: Model, parts, schema, path: str) -> DataFrame:
    """Scores of rows whose pairs are too many for a closure: each block gets those of its own trigrams."""
    kind = rows.withColumn("_block", F.lit(0).cast("long")).schema
    rows = packed.staged(rows.mapInArrow(_with_block, kind), path)
    keys = rows.select("_block", "text").mapInArrow(_block_keys, "_block long, key int").distinct()
    pairs = keys.join(_numbered(counts, model.languages), "key")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = model.having(right)
        return pa.Table.from_batches([x for b in left.combine_chunks().to_batches() for x in parts(own, b)])

    return rows.groupBy("_block").cogroup(pairs.groupBy("_block")).applyInArrow(run, schema)


def identify(
    docs: DataFrame, text: str = "text", declared: str | None = "lang", host: str | None = "source", suffix: str | None = None,
    least_posterior: float = LEAST_POSTERIOR, least_fit: float = LEAST_FIT,
) -> DataFrame:
    """Each row as the struct `row`, with `language`, `posterior`, `fit` and `kept`."""
    path = work_path(docs.sparkSession, "langid")
    column = lambda c: F.lower(F.trim(F.col(f"`{c}`").cast("string"))) if c else F.lit(None).cast("string")
    base = F.nullif(F.regexp_replace(column(declared), "^([a-z]{2,8})[-_].*$", "$1"), F.lit(""))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(own.alias("_row"), F.col(f"`{text}`").cast("string").alias("text"), base.alias("declared"),
                       column(host).alias("host"), column(suffix).alias("suffix"))
    plain = rows.select("text", "declared", "suffix", "host", F.substring_index("host", ".", -2).alias("domain"))
    model = _learn(plain, f"{path}/trigrams")
    if model is None:
        none = "cast(null AS string) AS language", "0.0D AS posterior", "0.0D AS fit", "false AS kept"
        return rows.selectExpr("_row AS row", *none)
    said = dict(map(tuple, plain.where("declared IS NOT NULL").groupBy("declared").count().collect()))
    totals = np.array([said[x] for x in model.languages], float)

    def listed(level: str) -> DataFrame:
        """Each value of the level with its rows by declared language, as pairs."""
        counts = plain.where(F.col(level).isNotNull() & F.col("declared").isNotNull()).groupBy(level, "declared").agg(F.count("*").alias("n"))
        return counts.groupBy(level).agg(F.collect_list(F.struct("declared", "n")).alias(f"by_{level}"))

    places = plain.select("host", "domain", "suffix").where("host IS NOT NULL OR suffix IS NOT NULL").distinct()
    for level in ("host", "domain", "suffix"):
        places = places.join(listed(level), level, "left")
    above_only = F.when(F.col("host") != F.col("domain"), F.col("by_host"))
    places = places.select(F.col("host").alias("_host"), F.col("suffix").alias("_suffix"), above_only.alias("by_host"), "by_domain", "by_suffix")
    places = packed.staged(places, f"{path}/places")
    same = F.col("host").eqNullSafe(F.col("_host")) & F.col("suffix").eqNullSafe(F.col("_suffix"))
    # The text goes through a shuffle once, inside its row.
    joined = rows.select("_row", "declared", "host", "suffix").join(places, same, "left").select(
        "_row", F.col("_row").getField(text).cast("string").alias("text"), "declared", "host", "suffix", "by_host", "by_domain", "by_suffix"
    )
    schema = joined.select("_row").schema.add("language", "string").add("posterior", "double").add("fit", "double").add("kept", "boolean")
    parts = _fuse(totals, least_posterior, least_fit)
    if model.whole:
        scored = joined.mapInArrow(lambda batches: (x for _, b in packed.blocks(batches, "text", BLOCK_BYTES) for x in parts(model, b)), schema)
    else:
        scored = _score_joined(joined, docs.sparkSession.read.parquet(f"{path}/trigrams"), model, parts, schema, f"{path}/blocks")
    return scored.withColumnRenamed("_row", "row")


def page_evidence(pages: DataFrame) -> DataFrame:
    """`page_id`, `text`, and what a page says besides: `lang` of its html tag, `host` and `suffix` of its address.

    The text is what stands outside tags, comments, scripts and styles; entities part words.
    Addresses without a host, or whose host does not end in a name, have null there.
    """
    named = lambda c, pattern: F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    host = named(F.lower("url"), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:@\[\]\s]+)")
    text = F.regexp_replace("html", r"(?s)<!--.*?(?:-->|\z)", " ")
    text = F.regexp_replace(text, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"<[/!?a-zA-Z][^>]*>", " "), r"&#?[0-9A-Za-z]+;", " ")
    out = pages.select("page_id", text.alias("text"), named("html", r"(?i)<html\b[^>]*?[\s:]lang\s*=\s*[\"']?([a-z0-9_-]+)").alias("lang"),
                       F.rtrim(host, F.lit(".")).alias("host"))
    return out.withColumn("suffix", named("host", r"\.([a-z][a-z0-9-]*)$"))
