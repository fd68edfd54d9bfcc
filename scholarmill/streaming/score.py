"""Scoring papers as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from scholarmill.models.bundle import ScoringModel


def start_scoring(model: ScoringModel, papers: DataFrame, keep: list[str], path: str,
                  checkpoint: str) -> StreamingQuery:
    """Stateless: every stage of the model is a projection.  Predictions are appended as Parquet."""
    scored = model.with_bounds(model.predict_upload(papers, keep))
    return (scored.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
