"""The detector against a brute-force loop, its edges, and its plans."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalguard.operators.detect import (
    MODELS,
    BandConfig,
    anomaly_records,
    detect_anomalies,
    union_branches,
    unpivot_signals,
)

START = dt.datetime(2024, 1, 1)


def make_rows(seed: int, sizes: dict) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for key, size in sizes.items():
        minute = 0
        for _ in range(size):
            minute += rng.randint(1, 400)
            value = None if rng.random() < 0.05 else rng.gauss(50, 5) + rng.choice([0, 0, 0, 60])
            rows.append((key, START + dt.timedelta(minutes=minute), value))
    rng.shuffle(rows)
    return rows


def brute_force(rows: list[tuple], config: BandConfig) -> dict:
    found = {}
    for key in {r[0] for r in rows}:
        series = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        xs = []
        for i, (_, ts, _v) in enumerate(series):
            if config.model == "trend":
                xs.append((ts - START).total_seconds() / 3600)
            elif config.model == "ar1":
                xs.append(series[i - 1][2] if i else None)
            else:
                xs.append(0.0)
        for i, (_, ts, y) in enumerate(series):
            first = 0 if config.max_training is None else max(0, i - config.max_training)
            pairs = [
                (xs[j], series[j][2])
                for j in range(first, i)
                if xs[j] is not None and series[j][2] is not None
            ]
            n = len(pairs)
            forecast = upper = lower = None
            if n >= config.min_training:
                px, py = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
                if config.model == "mean":
                    forecast, s = py.mean(), py.std(ddof=1)
                elif xs[i] is not None:
                    slope, intercept = np.polyfit(px, py, 1)
                    rest = py - (slope * px + intercept)
                    forecast = slope * xs[i] + intercept
                    s = math.sqrt((rest**2).sum() / (n - 2))
                if forecast is not None:
                    upper, lower = forecast + config.z * s, forecast - config.z * s
            odd = y is not None and upper is not None and (y > upper or y < lower)
            found[(key, ts)] = (forecast, upper, lower, odd, n)
    return found


@pytest.mark.parametrize("span", [None, "2 days"])
@pytest.mark.parametrize("cap", [None, 12, 25])
@pytest.mark.parametrize("model", MODELS)
def test_equals_brute_force(spark, model, cap, span):
    """Blocks that end exactly, series shorter than a block, NULL values and a NULL key."""
    rows = make_rows(7, {"a": 75, "b": 24, None: 40, "c": 5, "d": 1})
    config = BandConfig(model, min_training=6, max_training=cap, confidence=95.0)
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    result = detect_anomalies(df, ["k"], "t", "v", config, history_span=span).collect()
    expected = brute_force(rows, config)
    assert len(result) == len(expected)
    for row in result:
        forecast, upper, lower, odd, n = expected[(row.k, row.t)]
        assert row.r.training_size == n
        assert row.r.is_anomaly == odd
        for ours, theirs in zip(
            (row.r.forecast_value, row.r.upper_bound, row.r.lower_bound),
            (forecast, upper, lower),
            strict=True,
        ):
            assert (ours is None) == (theirs is None)
            if ours is not None:
                assert ours == pytest.approx(theirs, rel=1e-9, abs=1e-9)


def test_outlier_leaves_no_trace_after_the_cap(spark):
    """A huge value must not spoil the band once it is out of the last N rows."""
    values = [1e12, *[float(i % 3) for i in range(60)]]
    rows = [("a", START + dt.timedelta(minutes=i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    config = BandConfig(min_training=5, max_training=9)
    for span in (None, "10 minutes"):
        last = (
            detect_anomalies(df, ["k"], "t", "v", config, history_span=span)
            .orderBy(F.desc("t"))
            .first()
        )
        assert last.r.forecast_value == pytest.approx(1.0, abs=1e-12)
        assert (last.r.upper_bound - 1.0) / config.z == pytest.approx(
            np.std([0, 1, 2] * 3, ddof=1), rel=1e-12
        )


@pytest.mark.parametrize("size", [199, 200, 201])
def test_training_starts_at_the_minimum(spark, size):
    rows = [("a", START + dt.timedelta(minutes=i), float(i % 5)) for i in range(size)]
    rows.append(("a", START + dt.timedelta(days=1), 1000.0))
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    last = detect_anomalies(df, ["k"], "t", "v").orderBy(F.desc("t")).first()
    assert last.r.training_size == size
    assert last.r.is_anomaly == (size >= 200)
    assert (last.r.upper_bound is not None) == (size >= 200)


def test_sides_split_the_anomalies(spark):
    rows = make_rows(3, {"a": 200})
    df = spark.createDataFrame(rows, "k string, t timestamp, observed_value double")
    config = BandConfig(min_training=5, max_training=None, confidence=80.0)
    judged = detect_anomalies(df, ["k"], "t", "observed_value", config)
    both, high, low = (
        {(r.t, r.direction) for r in anomaly_records(judged, ["k", "t"], sides=s).collect()}
        for s in ("both", "high", "low")
    )
    assert high and low
    assert both == high | low
    assert {d for _, d in high} == {"HIGH"} and {d for _, d in low} == {"LOW"}
    with pytest.raises(ValueError):
        anomaly_records(judged, ["k"], sides="up")


def test_options_in_both_spellings():
    camel = BandConfig.from_options(
        {
            "minTrainingSize": 10,
            "maxTrainingSize": 20,
            "confidencePercentage": 95.0,
            "enableStl": False,
        }
    )
    snake = BandConfig.from_options(
        {
            "min_training_size": 10,
            "max_training_size": 20,
            "confidence_percentage": 95.0,
            "enable_stl": False,
        }
    )
    assert camel == snake == BandConfig(min_training=10, max_training=20, confidence=95.0)
    assert BandConfig().z == pytest.approx(3.2905, abs=1e-4)


@pytest.mark.parametrize(
    ("options", "error"),
    [
        ({"minTraining": 5}, ValueError),
        ({"enableStl": True}, NotImplementedError),
        ({"minTrainingSize": 1}, ValueError),
        ({"maxTrainingSize": 5}, ValueError),
        ({"confidencePercentage": 100.0}, ValueError),
    ],
)
def test_bad_options(options, error):
    with pytest.raises(error):
        BandConfig.from_options(options)


def test_unpivot_equals_union_of_branches(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, 3.0, 4.0)], "k int, a double, b double")
    one_scan = unpivot_signals(df, ["k"], ["a", "b"])
    branches = union_branches(
        *[df.select("k", F.lit(s).alias("signal"), F.col(s).alias("x")) for s in ("a", "b")]
    )
    assert sorted(map(str, one_scan.toDF("k", "s", "v").collect())) == sorted(
        map(str, branches.toDF("k", "s", "v").collect())
    )


def test_plan_has_one_exchange_for_all_windows(spark):
    rows = make_rows(1, {"a": 5})
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    plan = detect_anomalies(df, ["k"], "t", "v", BandConfig(max_training=300))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "Python" not in text
