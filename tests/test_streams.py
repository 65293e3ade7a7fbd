"""Streams give the rows of the batch job, also across many micro-batches and restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from signalguard.operators.detect import BandConfig, detect_anomalies
from signalguard.operators.escalate import escalate
from signalguard.operators.windows import tumble
from signalguard.plans.stages import Watch, anomaly_table, at_risk, diagnose, signal_anomalies
from signalguard.schemas import schema_of
from signalguard.session import shared_dir
from signalguard.sources.tables import scan, scan_stream
from signalguard.streaming.band import stream_band
from signalguard.streaming.run import (
    run_to_end,
    start_actions,
    start_table,
    start_written_steps,
    stream_session,
)

START = dt.datetime(2024, 1, 1)
READINGS = schema_of("k string, t timestamp, a double, b double")
WATCH = Watch(
    entity="k",
    ts="t",
    labels={"a": ("A", 1, "10"), "b": ("B", 1, "20")},
    band=BandConfig(min_training=8, max_training=15, confidence=90.0),
)


def readings(minutes: range, seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for minute in range(max(minutes) + 1):
        for key in ("x", "y", "z"):
            for second in (5, 35):
                bump = rng.choice([0.0] * 9 + [30.0])
                row = (
                    key,
                    START + dt.timedelta(minutes=minute, seconds=second),
                    None if rng.random() < 0.03 else rng.gauss(10, 2) + bump,
                    rng.gauss(20, 2) + bump,
                )
                if minute in minutes:
                    rows.append(row)
    return rows


def write_file(spark, path: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, READINGS).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def telemetry(spark):
    """Five files of 17 minutes in time order, then a row far ahead that closes all windows."""
    path = shared_dir(spark, "telemetry")
    for start in range(0, 85, 17):
        write_file(spark, path, readings(range(start, start + 17)))
    write_file(spark, path, [("flush", START + dt.timedelta(days=1), 0.0, 0.0)])
    return path


def batch_rows(spark, path):
    return scan(spark, path, READINGS).where("k <> 'flush'")


def as_set(df):
    doubles = {c for c, kind in df.dtypes if kind == "double"}
    cells = [F.round(c, 8).alias(c) if c in doubles else F.col(c) for c in sorted(df.columns)]
    return {tuple(r) for r in df.select(*cells).collect()}


@pytest.mark.parametrize(
    ("model", "cap"), [("mean", None), ("mean", 15), ("trend", 11), ("ar1", 9), ("ar1", None)]
)
def test_band_across_micro_batches(spark, telemetry, model, cap):
    """Caps of 9 to 15 rows cross several blocks in 85 minutes, in and between batches."""
    config = BandConfig(model, min_training=5, max_training=cap, confidence=90.0)

    def series(df):
        return tumble(df, "t", "1 minute", ["k"], [F.avg("a").alias("v")])

    keep = ["k", "window_time", "v", "r.*"]
    with stream_session(spark, 2):
        stream = scan_stream(spark, telemetry, READINGS, "t", files_per_trigger=1)
        judged = stream_band(series(stream), ["k"], "window_time", "v", config).select(*keep)
        got = run_to_end(judged, shared_dir(spark, "o"), shared_dir(spark, "c"))
        expected = detect_anomalies(
            series(batch_rows(spark, telemetry)), ["k"], "window_time", "v", config
        ).select(*keep)
        assert as_set(got) == as_set(expected)
        assert expected.where("is_anomaly").count() > 0


def test_chained_escalation(spark, telemetry):
    with stream_session(spark, 2):
        stream = scan_stream(spark, telemetry, READINGS, "t", files_per_trigger=2)
        risks = diagnose(at_risk(signal_anomalies(stream, WATCH), WATCH), WATCH)
        got = run_to_end(risks, shared_dir(spark, "o"), shared_dir(spark, "c"))
        batch = batch_rows(spark, telemetry)
        expected = diagnose(at_risk(signal_anomalies(batch, WATCH), WATCH), WATCH)
        assert as_set(got) == as_set(expected)
        assert got.count() > 0


def test_one_query_per_table(spark, telemetry):
    """Each stage streams the table of the stage before, with a watermark of its own."""
    with stream_session(spark, 2):
        source = scan_stream(spark, telemetry, READINGS, "t", files_per_trigger=2)
        anomalies = anomaly_table(signal_anomalies(source, WATCH))
        path = shared_dir(spark, "anomalies")
        stored = run_to_end(anomalies, path, shared_dir(spark, "c"))
        stream = scan_stream(spark, path, stored.schema, "window_time")
        got = run_to_end(at_risk(stream, WATCH), shared_dir(spark, "o"), shared_dir(spark, "c"))
        expected = at_risk(stored, WATCH)
        # The last roll-up window stays open: no later anomaly moves the watermark.
        newest = stored.agg(F.max("window_time")).first()[0] - dt.timedelta(seconds=5)
        closed = expected.where(F.col("window_end") <= F.lit(newest))
        assert as_set(got) == as_set(closed)
        assert 0 < got.count() <= expected.count()


def test_restart_from_the_checkpoint(spark):
    path, out, checkpoint = (shared_dir(spark, n) for n in ("in", "o", "c"))
    config = BandConfig(min_training=5, max_training=13, confidence=90.0)

    def job():
        stream = scan_stream(spark, path, READINGS, "t")
        series = tumble(stream, "t", "1 minute", ["k"], [F.avg("b").alias("v")])
        judged = stream_band(series, ["k"], "window_time", "v", config, only_anomalies=True)
        return judged.select("k", "window_time", "v", "r.*")

    with stream_session(spark, 2):
        for start in (0, 20, 40):
            write_file(spark, path, readings(range(start, start + 20)))
            run_to_end(job(), out, checkpoint)
        write_file(spark, path, [("flush", START + dt.timedelta(days=1), 0.0, 0.0)])
        got = run_to_end(job(), out, checkpoint)
        series = tumble(
            batch_rows(spark, path), "t", "1 minute", ["k"], [F.avg("b").alias("v")]
        )
        judged = detect_anomalies(series, ["k"], "window_time", "v", config)
        expected = judged.where("r.is_anomaly").select("k", "window_time", "v", "r.*")
        assert as_set(got) == as_set(expected)
        assert got.count() > 0


def test_late_rows_are_dropped_and_counted(spark):
    path = shared_dir(spark, "late")
    at = lambda m, s=0: START + dt.timedelta(minutes=m, seconds=s)
    write_file(spark, path, [("x", at(0, 10), 1.0, 0.0), ("x", at(0, 50), 3.0, 0.0)])
    write_file(spark, path, [("x", at(1, 5), 5.0, 0.0)])  # the watermark becomes 1:00
    write_file(spark, path, [("x", at(1, 10), 6.0, 0.0)])  # the first window comes out
    write_file(spark, path, [("x", at(0, 55), 99.0, 0.0), ("x", at(1, 30), 7.0, 0.0)])
    write_file(spark, path, [("x", at(5), 0.0, 0.0)])
    with stream_session(spark, 2):
        stream = scan_stream(spark, path, READINGS, "t", files_per_trigger=1)
        windows = tumble(stream, "t", "1 minute", ["k"], [F.avg("a").alias("v")])
        out = shared_dir(spark, "o")
        job = start_table(windows, out, shared_dir(spark, "c"))
        job.awaitTermination()
    dropped = sum(
        s.numRowsDroppedByWatermark for p in job.recentProgress for s in p.stateOperators
    )
    got = scan(spark, out, windows.schema).orderBy("window_start").collect()
    assert [(r.window_start, r.v) for r in got] == [(at(0), 2.0), (at(1), 6.0)]
    assert dropped == 1


def test_actions_per_micro_batch(spark, telemetry):
    """A side effect per batch, written before anything else reads it."""
    out = shared_dir(spark, "acted")

    def act(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    with stream_session(spark, 2):
        stream = scan_stream(spark, telemetry, READINGS, files_per_trigger=2)
        start_actions(stream.select("k"), act, shared_dir(spark, "c")).awaitTermination()
    done = spark.read.schema("k string, batch_id bigint").parquet(out)
    assert done.count() == batch_rows(spark, telemetry).count() + 1
    assert done.select("batch_id").distinct().count() == 3


def test_written_steps_are_stored_and_replaced(spark, telemetry):
    """Each step reads the stored rows of the step before; a repeated batch adds nothing."""
    first, second = shared_dir(spark, "first"), shared_dir(spark, "second")
    seen = []

    def upper(batch):
        return batch.select(F.upper("k").alias("k"), "t")

    def tagged(batch):
        seen.extend(batch.inputFiles())
        return batch.withColumn("tag", F.concat("k", F.lit("!")))

    with stream_session(spark, 2):
        for checkpoint in ("c1", "c2"):  # a new checkpoint replays all batches
            stream = scan_stream(spark, telemetry, READINGS, files_per_trigger=3)
            start_written_steps(
                stream, [(first, upper), (second, tagged)], shared_dir(spark, checkpoint)
            ).awaitTermination()
    done = spark.read.parquet(second)
    assert done.count() == batch_rows(spark, telemetry).count() + 1
    assert {r.tag for r in done.select("tag").distinct().collect()} == {"X!", "Y!", "Z!", "FLUSH!"}
    assert seen and all("/first-" in f for f in seen)


def test_window_on_window_keeps_the_watermark(spark, telemetry):
    with stream_session(spark, 2):
        stream = scan_stream(spark, telemetry, READINGS, "t")
        inner = tumble(stream, "t", "1 minute", ["k"], [F.max("b").alias("observed_value")])
        hot = inner.where("observed_value > 25").withColumn("signal", F.lit("b"))
        risks = escalate(
            hot.select("k", "window_time", "signal", "observed_value"), "k", ["b"], min_signals=1
        )
        got = run_to_end(risks, shared_dir(spark, "o"), shared_dir(spark, "c"))
    assert got.count() > 0
