"""Streaming.

The reference analyses are batch jobs only: no stream source, watermark, window or state
appears in them, so there is no streaming operator to rebuild. The operators in
``rankfold.operators`` are plain DataFrame transformations, so the aggregating ones
(word counts, histograms, keyed totals, popularity counts) also run unchanged on a
``readStream`` DataFrame in ``complete`` output mode; ``incremental`` wires one up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def incremental(stream: DataFrame, operator: Callable[[DataFrame], DataFrame], query_name: str,
                checkpoint: str, path: str):
    """Start ``operator(stream)`` as a streaming query that keeps the full result in the
    Parquet folder ``path``, rewritten for every batch (complete mode). Executors write it;
    nothing is held in the driver. ``checkpoint`` and ``path`` must be shared folders on a
    cluster."""
    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return (operator(stream).writeStream.outputMode("complete").foreachBatch(replace)
            .queryName(query_name).option("checkpointLocation", checkpoint).start())
