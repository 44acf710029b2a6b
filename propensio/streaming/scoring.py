"""Apply a fitted feature model and classifier to a Structured Streaming frame.

Scoring is a per-row projection (features are literals from the fit, the
model is a fitted pipeline), so a stream needs no state, watermark or window.
The sink's checkpoint goes under the session's shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from propensio.session import work_dir


def score_stream(stream: DataFrame, features, model=None, score_fn=None, threshold: float = 0.5) -> DataFrame:
    """Features → score → prediction on every micro-batch row."""
    engineered = features.transform(stream)
    if model is not None:
        scored = model.predict_proba(engineered)
    elif score_fn is not None:
        scored = engineered.withColumn("score", score_fn())
    else:
        raise ValueError("give a fitted model or a score expression")
    return scored.withColumn("prediction", (F.col("score") >= F.lit(threshold)).cast("int"))


def start_scoring(scored: DataFrame, sink_format: str, name: str, path: str | None = None,
                  trigger_once: bool = False) -> StreamingQuery:
    writer = scored.writeStream.format(sink_format).outputMode("append").queryName(name)
    writer = writer.option("checkpointLocation", work_dir(scored.sparkSession, f"stream-{name}"))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()
