"""Regression model: fit, evaluate, save/load, score."""

import datetime as dt
import random

import pytest

from stationflow.operators import model as ML
from stationflow.session import shared_path

T0 = dt.datetime(2025, 1, 5, 0, 0)


def _rows(spark, n=300, noise=0.0, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        t, w, c = rnd.uniform(-5, 25), rnd.uniform(0, 10), float(rnd.randrange(0, 101, 10))
        y = 0.4 + 0.01 * t - 0.02 * w + 0.001 * c + rnd.gauss(0, noise)
        rows.append((t, w, c, y, T0 + dt.timedelta(hours=i)))
    return spark.createDataFrame(rows, "temperature double, wind_speed double, "
                                       "cloudiness double, avg_utilization double, "
                                       "window_start timestamp")


def test_ols_recovers_known_coefficients(spark):
    model = ML.train(_rows(spark))
    c = ML.coefficients(model)
    assert c["intercept"] == pytest.approx(0.4, abs=1e-9)
    assert c["coef_temperature"] == pytest.approx(0.01, abs=1e-9)
    assert c["coef_wind_speed"] == pytest.approx(-0.02, abs=1e-9)
    assert c["coef_cloudiness"] == pytest.approx(0.001, abs=1e-9)


def test_rmse_frame_equals_evaluator(spark):
    train, test = ML.window_split(_rows(spark, noise=0.05))
    model = ML.train(train)
    sql_form = ML.rmse(model.transform(test)).first()["rmse"]
    assert sql_form == pytest.approx(ML.evaluate(model, test), rel=1e-12)


def test_window_split_is_by_hour_and_covers_all(spark):
    rows = _rows(spark, n=100)
    train, test = ML.window_split(rows)
    assert train.count() + test.count() == 100
    assert train.count() == 70  # 100 consecutive hours, 7 of every 10


def test_random_split_matches_reference_call(spark):
    rows = _rows(spark, n=200).repartition(1)
    a = ML.random_split(rows)[0].count()
    b = rows.randomSplit([0.7, 0.3], seed=42)[0].count()
    assert a == b


def test_null_features_and_labels_are_dropped(spark):
    report = spark.createDataFrame(
        [(1.0, 2.0, 3.0, 0.5, T0), (None, 2.0, 3.0, 0.5, T0), (1.0, 2.0, 3.0, None, T0)],
        "temperature float, wind_speed float, cloudiness float, avg_utilization double, "
        "window_start timestamp")
    assert ML.training_rows(report).count() == 1
    assert ML.training_rows(report.union(report), grain="window").count() == 1


def test_save_load_round_trip_and_int_cloudiness(spark):
    model = ML.train(_rows(spark))
    path = shared_path(spark, "tests", "model")
    ML.save(model, path)
    loaded = ML.load(path)
    fc = spark.createDataFrame([(10.0, 3.0, 40)], "temperature double, wind_speed double, "
                                                  "cloudiness int")
    a = ML.score(model, fc).first()["prediction"]
    b = ML.score(loaded, fc).first()["prediction"]
    assert a == b == pytest.approx(0.4 + 0.1 - 0.06 + 0.04, abs=1e-9)


def test_split_fractions_are_exact_or_refused():
    import pytest
    from stationflow.operators.model import split_steps
    assert [split_steps(f) for f in (0.8, 0.75, 0.95, 0.125)] == [10, 100, 100, 1000]
    for bad in (0.0, 1.0, 1 / 3):
        with pytest.raises(ValueError):
            split_steps(bad)
