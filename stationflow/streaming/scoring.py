"""Scoring a stream (M9): landed forecast payloads -> rows -> predictions of a saved
model, with the model's version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow.operators import model as ML
from stationflow.operators.normalize import flatten_forecast


def start_score_stream(payloads: DataFrame, model_path: str, *, sink_path: str, checkpoint_path: str,
                       horizons: str = "all", trigger: dict | None = None) -> StreamingQuery:
    """Append the predictions for every new forecast payload (column ``payload``, others
    are kept) as Parquet. The model is read once, at the start; ``model_version`` is
    the id that it got when it was fitted. Spark's file sink lists whole batches, so
    a batch that runs again adds nothing."""
    model = ML.load(model_path)
    scored = ML.score(model, flatten_forecast(payloads, horizons=horizons)).drop("features") \
        .withColumn("model_version", F.lit(model.uid))
    writer = (scored.writeStream.outputMode("append").format("parquet").option("path", sink_path)
              .option("checkpointLocation", checkpoint_path))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
