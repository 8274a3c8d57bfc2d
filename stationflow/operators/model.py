"""Weather -> average utilization regression.

A ``Pipeline`` of ``VectorAssembler`` (temperature, wind_speed, cloudiness)
and ``LinearRegression`` on ``avg_utilization`` with Spark's defaults (solver
``auto`` = normal equations for few features: the Gram matrix is summed on the
executors, the 4x4 system is solved on the driver). Training rows with a NULL
feature or label are dropped first (they would fail the fit).

Splits: ``random_split`` is ``randomSplit([0.7, 0.3], seed=42)`` - its rows
depend on the partitioning; ``window_split`` is reproducible anywhere: a
window goes to the training side when its hour number (hours since the epoch)
modulo 10 is below 7, so all stations of one hour land on the same side.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stationflow.schemas import FEATURE_COLUMNS, LABEL_COLUMN

TRAIN_FRACTION = 0.7
SEED = 42


def training_rows(report: DataFrame, *, grain: str = "station", counts: Observation | None = None) -> DataFrame:
    """Features, label and window_start from the report, NULLs dropped. ``counts``
    gets ``rows`` and ``null_rows``, those dropped, from the job that reads the rows,
    such as the fit.

    ``grain="station"`` keeps one row per station per window, as the report
    has them (windows weigh by their station count); ``grain="window"`` keeps
    one row per distinct window / weather / label.
    """
    cols = [*FEATURE_COLUMNS, LABEL_COLUMN, "window_start"]
    needed = [*FEATURE_COLUMNS, LABEL_COLUMN]
    rows = report.select(*cols)
    if counts is not None:
        some_null = F.exists(F.array(*[F.col(c).isNull() for c in needed]), lambda x: x)
        rows = rows.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(some_null).alias("null_rows"))
    rows = rows.dropna(subset=needed)
    if grain == "window":
        rows = rows.dropDuplicates()
    elif grain != "station":
        raise ValueError(f"grain must be 'station' or 'window', not {grain!r}")
    return rows


def random_split(rows: DataFrame, fraction: float = TRAIN_FRACTION,
                 seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    train, test = rows.randomSplit([fraction, 1.0 - fraction], seed=seed)
    return train, test


def split_steps(fraction: float) -> int:
    """The fewest parts (10 to 10,000) of which ``fraction`` is a whole number;
    neither side of the split may be empty."""
    for steps in (10, 100, 1_000, 10_000):
        part = fraction * steps
        if abs(part - round(part)) < 1e-9 and 0 < round(part) < steps:
            return steps
    raise ValueError(f"fraction must be a multiple of 1/10000 between 0 and 1, not {fraction}")


def is_train_window(ts: str = "window_start", fraction: float = TRAIN_FRACTION) -> Column:
    hour = F.floor(F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                          f"CAST({ts} AS TIMESTAMP_NTZ))") / 3600)
    steps = split_steps(fraction)
    return F.pmod(hour, F.lit(steps)) < int(round(fraction * steps))


def window_split(rows: DataFrame, fraction: float = TRAIN_FRACTION,
                 ts: str = "window_start") -> tuple[DataFrame, DataFrame]:
    side = is_train_window(ts, fraction)
    return rows.where(side), rows.where(~side)


def pipeline(handle_invalid: str = "error") -> Pipeline:
    assembler = VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features",
                                handleInvalid=handle_invalid)
    return Pipeline(stages=[assembler,
                            LinearRegression(featuresCol="features", labelCol=LABEL_COLUMN)])


def train(rows: DataFrame, handle_invalid: str = "error") -> PipelineModel:
    """Fit the pipeline. Spark ML makes several passes over its input, so
    uncached rows are persisted for the fit (lost blocks are recomputed from
    lineage) and released afterwards."""
    level = rows.storageLevel
    cached = level.useMemory or level.useDisk
    if not cached:
        rows = rows.persist()
    try:
        return pipeline(handle_invalid).fit(rows)
    finally:
        if not cached:
            rows.unpersist()


def rmse(predictions: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """A7 as a one-row DataFrame: sqrt(avg((prediction - label)^2))."""
    err = F.col("prediction") - F.col(label)
    return predictions.agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def evaluate(model: PipelineModel, test: DataFrame) -> float:
    """M6: RMSE on ``test`` with Spark's evaluator (a scalar, for callers)."""
    return RegressionEvaluator(labelCol=LABEL_COLUMN, predictionCol="prediction",
                               metricName="rmse").evaluate(model.transform(test))


def coefficients(model: PipelineModel) -> dict[str, float]:
    lr = model.stages[-1]
    out = {"intercept": float(lr.intercept)}
    out.update({f"coef_{c}": float(v) for c, v in zip(FEATURE_COLUMNS, lr.coefficients)})
    return out


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def scoring_rows(spark, rows) -> DataFrame:
    """Literal forecast rows ``(temperature, wind_speed, cloudiness)`` with
    the fixed scoring schema; Python ints are widened for the double columns
    (a bare int in a DoubleType column is rejected by ``createDataFrame``)."""
    from stationflow.schemas import SCORING_ROW
    fixed = [(None if t is None else float(t), None if w is None else float(w),
              None if c is None else int(c)) for t, w, c in rows]
    return spark.createDataFrame(fixed, SCORING_ROW)


def score(model: PipelineModel, forecasts: DataFrame) -> DataFrame:
    """M9: predictions for any frame (or stream) of forecast rows; an int
    ``cloudiness`` is accepted by the assembler."""
    return model.transform(forecasts)
