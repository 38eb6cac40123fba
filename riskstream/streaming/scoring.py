"""Score a feature stream and write decisions with the state they rest on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.operators import model as model_ops
from riskstream.streaming.archive import write_batch


def decide_stream(
    features: DataFrame,
    model: PipelineModel,
    enrich: Callable[[DataFrame], DataFrame],
    decide: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Enrich, score and decide each micro-batch.

    ``enrich`` adds reference columns and watchlist flags, read anew per batch;
    ``decide`` is ``operators.decisions.decide`` with its thresholds bound.
    ``decided_at`` is the time of the micro-batch. A batch run again replaces the
    decisions of its first try.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        made = decide(model_ops.score(model, enrich(rows)))
        write_batch(made.withColumn("decided_at", F.current_timestamp()), path, batch_id)

    return (
        features.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
