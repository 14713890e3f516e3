"""Registered queries of the operators on texts that run Arrow code inside tasks."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloom.llm import bpe, jaccard, langid, lm, repeats, tiling, toxicity, warc
from scoreloom.llm.registry import query, table
from scoreloom.session import work_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def bpe_digests(batches):
    """Digests of the ids and of the bytes that they decode to, in one pass."""
    for batch in bpe.decoder(RANKS)(batches):
        ids = batch.column("ids")
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        digest = lambda x: hashlib.sha256(x).hexdigest()
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"),
            "n_tokens": pa.array(sizes, pa.int64()),
            "ids_sha256": pa.array([digest(flat[e - n : e].tobytes()) for n, e in zip(sizes, ends)], pa.string()),
            "decoded_sha256": pa.array([digest(x.as_buffer()) for x in batch.column("decoded")], pa.string()),
        })


@query()
def op1_byte_bpe(spark, sf_dir):
    """Every document encoded, then decoded from its ids."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), RANKS, PATTERN)
    return encoded.mapInArrow(
        bpe_digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


@query()
def op5_interpolated_lm(spark, sf_dir):
    """Every document scored by a model of the documents of the other six folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = lm.score_texts(docs, fold("doc_id", 7) != 2, fold("doc_id", 7) == 3)
    return scores.select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query()
def op9_partenum_join(spark, sf_dir):
    """Near-duplicate classes of all documents."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op7_induced_dedup(spark, sf_dir):
    """Every document without the bytes of 200-byte strings that stand elsewhere as well."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op4_string_tiling(spark, sf_dir):
    """Pairs of a document and the benchmark item whose tokens it covers by half or more."""
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op2_warc(spark, sf_dir):
    """All pages written as archives in the shared folder, then read back."""
    folder = work_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), folder, least_bytes=0)
    return warc.read_archive(spark, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query()
def op6_toxicity(spark, sf_dir):
    """Every document scored by models of the labelled documents outside fold 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.learn(docs, labels, fold("doc_id", 5) != 0)
    scores = toxicity.score_texts(docs, model)
    return scores.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query()
def op8_language_id(spark, sf_dir):
    """The language of every document; `kept` is false where none is likely enough."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return langid.identify(docs).select(F.col("row.doc_id").alias("doc_id"), "language", "posterior", "fit", "kept")


@query()
def op8_page_language(spark, sf_dir):
    """The language of every page by its text, html tag, address suffix and host."""
    pages = langid.page_evidence(table(spark, sf_dir, "pages"))
    scored = langid.identify(pages, host="host", suffix="suffix")
    return scored.select(F.col("row.page_id").alias("page_id"), "language", "posterior", "fit", "kept")
