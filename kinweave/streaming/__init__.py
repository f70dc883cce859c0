"""Inference over a stream of anchors, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def score_stream(anchors: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Scores each micro-batch of anchors and writes it under its batch id, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return anchors.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
