"""Structured Streaming form of the incremental merge (the funnel itself is a batch).

Each micro-batch of delta rows is folded and merged into the newest snapshot,
which is written under the batch's number; a batch that is run again finds its
snapshot and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from recordloom.operators.merge import merge_delta
from recordloom.sources.sinks import _exists


def merge_stream(deltas: DataFrame, base: DataFrame, root: str, checkpoint: str, key: str, order: str) -> StreamingQuery:
    """Starts the query; snapshot n holds the base with batches 0 to n merged."""

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        at = f"{root}/snapshot={n:06d}"
        if _exists(spark, f"{at}/_SUCCESS"):
            return
        before = base if n == 0 else spark.read.parquet(f"{root}/snapshot={n - 1:06d}")
        merge_delta(before, batch, key, order).drop("origin").write.mode("overwrite").parquet(at)

    return deltas.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
