"""Row counts of the micro-batches that arrive in a directory."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

TRIGGER = "5 seconds"


def run_monitor(
    arrivals: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write one row `(batch_id, row_count)` per micro-batch that has rows.

    Each batch owns its folder, so a replayed batch replaces its own row.
    """
    def count(batch: DataFrame, batch_id: int) -> None:
        counted = batch.agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 0")
        folder = posixpath.join(path, f"batch_id={batch_id}")
        counted.write.mode("overwrite").parquet(folder)

    return (
        arrivals.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .foreachBatch(count)
        .start()
    )


def read_counts(spark, path: str) -> DataFrame:
    return spark.read.schema("row_count BIGINT, batch_id BIGINT").parquet(path).select(
        "batch_id", "row_count"
    )
