"""Title search by an inverted index of trigrams.

Every three consecutive characters of a title make a posting (gram, key); two end marks
make sure that every single character starts a gram as well. A keyword's own trigrams are
looked up by equality, shorter keywords by the start of a gram; keys that have them all are
candidates, and `contains` on the title itself decides. So the answer equals a scan of all
titles, while only the keyword's postings and the candidates' titles are read.

The index is built over a text of the caller's choice: `lower(title)` for searches in any letter case,
the title itself for case-sensitive ones. Postings are sorted by gram, and a frequent gram
continues over several files, as the key is in the sort order too.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators.search import required

GRAM = 3
END = "\u0001"
FILES = 64


def grams(text: Column) -> Column:
    """The distinct grams of a text, those at its end filled up with marks."""
    padded = F.concat(text, F.lit(END * (GRAM - 1)))
    starts = F.sequence(F.lit(1), F.length(text))
    return F.when(F.length(text) > 0, F.array_distinct(F.transform(starts, lambda i: F.substr(padded, i, F.lit(GRAM)))))


def keyword_grams(keyword: str) -> list[str]:
    return sorted({keyword[i : i + GRAM] for i in range(len(keyword) - GRAM + 1)})


def create(items: DataFrame, path: str, text: Column, key: str = "row_key", files: int = FILES) -> None:
    """Write items sorted by key, and the postings of `text` sorted by gram."""
    by_key = items.repartitionByRange(files, key).sortWithinPartitions(key)
    by_key.withColumn("_text", text).write.parquet(posixpath.join(path, "items"))
    stored = items.sparkSession.read.parquet(posixpath.join(path, "items"))
    postings = stored.select(F.explode(grams(F.col("_text"))).alias("gram"), F.col(key).alias("key"))
    dealt = postings.repartitionByRange(files, "gram", "key").sortWithinPartitions("gram", "key")
    dealt.write.parquet(posixpath.join(path, "postings"))


def candidates(spark: SparkSession, path: str, keyword: str) -> DataFrame:
    """(key): items that have all grams of the keyword."""
    postings = spark.read.parquet(posixpath.join(path, "postings"))
    if len(keyword) < GRAM:
        return postings.where(F.col("gram").startswith(keyword)).select("key").distinct()
    wanted = keyword_grams(keyword)
    found = postings.where(F.col("gram").isin(wanted))
    counted = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"))  # a key has a gram once
    return counted.where(F.col("n") == len(wanted)).select("key")


def search(spark: SparkSession, path: str, keyword: str, key: str = "row_key") -> DataFrame:
    """Items whose indexed text contains the keyword, which is given in the form of that text."""
    required(keyword, "keyword")
    items = spark.read.parquet(posixpath.join(path, "items"))
    # A gram holds no end mark but at an end, so such a keyword is compared with all texts.
    if END not in keyword:
        found = candidates(spark, path, keyword).withColumnRenamed("key", key)
        items = items.join(found, key, "left_semi")
    return items.where(F.col("_text").contains(keyword)).drop("_text")
