"""A training corpus from `documents`: five stages, each a Parquet table of the next one's input.

1. language: documents whose language cannot be told are dropped.
2. near_duplicates: of each class of near copies one row stays, that of the smallest id (rows
   without an id come last). Texts without words are in no class and stay.
3. repeats: bytes of strings of 200 bytes that stand elsewhere as well are cut; a character
   of which a byte is cut goes as a whole, and no other one. A document that is cut away whole is
   kept as an empty text: it is a row of the corpus that says nothing.
4. decontaminate: documents that cover half of a benchmark item go.
5. encode: the texts as BPE ids, with the other columns.

Each function takes (spark, docs, sf_dir) and works on all rows it is given. As ids may be null or
stand more than once, stages 2 to 4 name rows by 64-bit hashes of what decides: stage 2 of the whole
row, stage 3 of id and text, stage 4 of the text. No numbered copy of the table is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom.llm import bpe, jaccard, langid, packed, repeats, tiling
from scoreloom.llm.registry import table
from scoreloom.llm.text_queries import PATTERN, RANKS
from scoreloom.session import work_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.identify(docs.select(*COLUMNS)).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.xxhash64(*COLUMNS).alias("_row"), *COLUMNS)
    classes = jaccard.near_duplicates(rows, "_row").select(
        F.col("doc_id").alias("_row"), F.col("component_id").alias("_class"), (F.col("n_shingles") == 0).alias("_blank")
    )
    named = rows.select("_row", "doc_id").distinct().join(classes.distinct(), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first")
    stay = named.groupBy("_class", "_blank").agg(first).select("first._row", "_blank")
    # Rows alike in all columns have one hash: one of them stays, or all where no word is in them.
    copy = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
    return rows.join(stay, "_row").withColumn("_copy", copy).where("_copy = 1 OR _blank").select(*COLUMNS)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Only texts that lose something come back; the same id and text lose the same.
    cut = repeats.remove_repeats(docs, whole=True).where("n_removed > 0").select(
        F.col("doc_id").alias("_id"), "text_hash", F.col("kept").cast("string").alias("_kept")
    )
    cut = cut.dropDuplicates(["_id", "text_hash"])
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("text_hash"))
    left = docs.select(*COLUMNS).join(cut, same, "left").withColumn("text", F.coalesce("_kept", "text"))
    return left.select(*COLUMNS[:-1], F.length("text").cast("long").alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.xxhash64("text").alias("_row"), *COLUMNS)
    leaks = tiling.contaminated(rows, table(spark, sf_dir, "benchmark"), id_column="_row")
    return rows.join(leaks.select(F.col("doc_id").alias("_row")).distinct(), "_row", "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, RANKS, PATTERN).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("remove_repeats", remove_repeats),
    ("decontaminate", decontaminate),
    ("encode", encode),
]
ORACLE_SQL = None  # near duplicates and repeats cannot be stated in SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = packed.staged(stage(spark, docs, sf_dir), work_path(spark, f"pipeline-{name}"))
    return docs
