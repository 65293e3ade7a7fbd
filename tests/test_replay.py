"""Ending a stream, seeding it from stored history, retiring keys, chaining jobs by tables."""

import datetime as dt
import random
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_streams import READINGS, START, WATCH, as_set, batch_rows, readings, write_file

from signalguard.operators.detect import BandConfig, detect_anomalies
from signalguard.operators.windows import tumble
from signalguard.plans.stages import (
    anomaly_table,
    at_risk,
    diagnose,
    signal_anomalies,
    window_anomalies,
    windowed_signals,
)
from signalguard.schemas import schema_of
from signalguard.session import shared_dir
from signalguard.sources.tables import EndOfInput, scan, scan_stream
from signalguard.streaming import band as band_module
from signalguard.streaming.band import BandProcessor, band_seed, stream_band
from signalguard.streaming.late import start_late_split
from signalguard.streaming.prefix import Moments, band, merge, prefixes, suffixes
from signalguard.streaming.run import (
    run_to_end,
    scan_batches,
    start_split,
    start_table,
    start_written_steps,
    stream_session,
)
from signalguard.streaming.staged import Stage, StagedTables

KEEP = ["k", "window_time", "v", "r.*"]

# Workers cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(scope="module")
def telemetry(spark):
    """Five files of 17 minutes in time order; nothing closes the last windows."""
    path = shared_dir(spark, "replay")
    for start in range(0, 85, 17):
        write_file(spark, path, readings(range(start, start + 17)))
    return path


def end_of(spark):
    return EndOfInput(spark, shared_dir(spark, "end"), READINGS, "t")


def series(df):
    return tumble(df, "t", "1 minute", ["k"], [F.avg("a").alias("v")])


# --- arithmetic ------------------------------------------------------------------------


def naive(xs, ys):
    ok = ~(np.isnan(xs) | np.isnan(ys))
    x, y = xs[ok], ys[ok]
    if not len(y):
        return (0, 0, 0, 0, 0, 0)
    dx, dy = x - x.mean(), y - y.mean()
    return (len(y), x.mean(), y.mean(), (dx * dx).sum(), (dy * dy).sum(), (dx * dy).sum())


def test_prefixes_and_suffixes():
    rng = np.random.default_rng(4)
    xs, ys = rng.normal(size=(300, 2)), rng.normal(1e6, 1, size=(300, 2))
    ys[rng.random(ys.shape) < 0.2] = np.nan
    ys[100, 0] = 1e12  # an outlier spoils no state that does not hold it
    before, after = prefixes(xs, ys).flat(), suffixes(xs, ys).flat()
    for i in range(300):
        for s in range(2):
            np.testing.assert_allclose(before[i, s], naive(xs[: i + 1, s], ys[: i + 1, s]), 1e-7, 1e-7)
            np.testing.assert_allclose(after[i, s], naive(xs[i:, s], ys[i:, s]), 1e-7, 1e-7)
    back = Moments.from_flat(before)
    assert all((a == b).all() for a, b in zip(back, prefixes(xs, ys), strict=True))
    whole = merge(back.rows(99), suffixes(xs[100:], ys[100:]).rows(0)).flat()
    np.testing.assert_allclose(whole, before[-1], 1e-7)


def test_band_needs_training():
    m = Moments(*np.array([[1.0], [0.0], [5.0], [0.0], [0.0], [0.0]]))
    assert np.isnan(band(m, np.array([1.0]), "mean", 2, 3.0)).all()
    assert np.isnan(band(m, np.array([1.0]), "trend", 1, 3.0)).all()  # no slope from one point


class ValueStore:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class ListStore:
    def __init__(self):
        self.listed = []

    def get(self):
        return iter(self.listed)

    def appendList(self, values):
        self.listed += values

    def clear(self):
        self.listed = []


class MapStore:
    def __init__(self):
        self.mapped = {}

    def getValue(self, key):
        return self.mapped[key]

    def updateValue(self, key, value):
        self.mapped[key] = value

    def clear(self):
        self.mapped = {}


class Handle:
    def __init__(self):
        self.value, self.list, self.map, self.timers = ValueStore(), ListStore(), MapStore(), []

    def getValueState(self, *_):
        return self.value

    def getListState(self, *_):
        return self.list

    def getMapState(self, *_):
        return self.map

    def registerTimer(self, at):
        self.timers.append(at)


def frames(n, seed=1):
    rng = np.random.default_rng(seed)
    ys = rng.normal(10, 2, size=(n, 2))
    ys[rng.random(ys.shape) < 0.1] = np.nan
    return pd.DataFrame(
        {
            "k": "a",
            "at": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), "min"),
            "micros": np.arange(n) * 60_000_000,
            "hours": np.arange(n) / 60,
            "y0": ys[:, 0],
            "y1": ys[:, 1],
        }
    )


def judged(config, calls, chunk=None, monkeypatch=None, **options):
    """Rows of a processor that gets lists of frames, one list per micro-batch."""
    if chunk:
        monkeypatch.setattr(band_module, "CHUNK", chunk)
    processor = BandProcessor(config, ["k"], ["p", "q"], False, **options)
    handle = Handle()
    processor.init(handle)
    out = []
    for call in calls:
        found = list(processor.handleInputRows(("a",), iter(call), None))
        assert all(len(f) <= 2 * band_module.CHUNK for f in found)
        out += found
    return pd.concat(out).sort_values(["ts", "name"], ignore_index=True)


@pytest.mark.parametrize("model", ["mean", "trend", "ar1"])
@pytest.mark.parametrize("cap", [None, 70, 150])
def test_many_chunks_of_one_key(model, cap, monkeypatch):
    """A backlog in many unsorted chunks, in small output chunks, and row by row: all alike."""
    config = BandConfig(model, min_training=5, max_training=cap, confidence=90.0)
    whole = frames(700)
    once = judged(config, [[whole]])
    shuffled = whole.sample(frac=1, random_state=3)
    chunks = [shuffled.iloc[i : i + 37] for i in range(0, 700, 37)]
    batches = [[whole.iloc[i : i + 1]] for i in range(300)] + [[whole.iloc[300:]]]
    for calls, chunk in (([chunks], 16), (batches, 64)):
        got = judged(config, calls, chunk, monkeypatch)
        pd.testing.assert_frame_equal(got, once, rtol=1e-9)
    assert once["is_anomaly"].any()


# --- the end of the input --------------------------------------------------------------


@pytest.mark.parametrize(("files", "at_once"), [(1, False), (2, False), (None, True)])
def test_a_closed_stream_is_complete(spark, telemetry, files, at_once):
    with stream_session(spark, 2):
        end = end_of(spark)
        stream = scan_stream(spark, telemetry, READINGS, "t", files_per_trigger=files, end=end)
        risks = at_risk(signal_anomalies(stream, WATCH), WATCH)
        out, checkpoint = shared_dir(spark, "o"), shared_dir(spark, "c")
        got = run_to_end(risks, out, checkpoint, end, at_once)
        expected = at_risk(signal_anomalies(batch_rows(spark, telemetry), WATCH), WATCH)
        assert as_set(got) == as_set(expected)
        assert got.count() > 0


# --- seeds -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("model", "cap", "cut"),
    [
        ("mean", None, 40),
        ("mean", 15, 1),
        ("mean", 15, 30),
        ("trend", 11, 47),
        ("ar1", 9, 50),
        ("ar1", None, 84),
    ],
)
def test_seeded_stream_goes_on_where_the_batch_ended(spark, telemetry, model, cap, cut):
    config = BandConfig(model, min_training=5, max_training=cap, confidence=90.0)
    at = START + dt.timedelta(minutes=cut)
    with stream_session(spark, 2):
        whole = detect_anomalies(
            series(batch_rows(spark, telemetry)), ["k"], "window_time", "v", config
        ).select(*KEEP)
        past = batch_rows(spark, telemetry).where(F.col("t") < F.lit(at)).where("k <> 'z'")
        seed = band_seed(series(past), ["k"], "window_time", "v", config)
        end = end_of(spark)
        stream = scan_stream(spark, telemetry, READINGS, "t", files_per_trigger=2, end=end)
        live = stream.where((F.col("t") >= F.lit(at)) | (F.col("k") == "z"))
        judged = stream_band(series(live), ["k"], "window_time", "v", config, seed=seed)
        got = run_to_end(judged.select(*KEEP), shared_dir(spark, "o"), shared_dir(spark, "c"), end)
        # Key z has no stored history: the stream has it from its first row on.
        expected = whole.where((F.col("window_time") >= F.lit(at)) | (F.col("k") == "z"))
        assert as_set(got) == as_set(expected)


# --- retirement ------------------------------------------------------------------------


def silent_rows():
    """Key x every minute, key y with a silence of 30 minutes, key w once at the start."""
    rng = random.Random(9)
    rows = [("w", START, 1.0, 0.0)]
    for minute in range(90):
        at = START + dt.timedelta(minutes=minute)
        rows.append(("x", at, rng.gauss(5, 1), 0.0))
        if minute < 25 or minute >= 55:
            rows.append(("y", at, rng.gauss(5, 1), 0.0))
    return rows


@pytest.mark.parametrize(("files", "cap"), [(None, None), (1, None), (1, 10)])
def test_silent_keys_start_anew_and_their_state_goes(spark, files, cap):
    path = shared_dir(spark, "silent")
    rows = silent_rows()
    for start in range(0, 90, 15):
        low, high = (START + dt.timedelta(minutes=m) for m in (start, start + 15))
        write_file(spark, path, [r for r in rows if low <= r[1] < high])
    config = BandConfig(min_training=5, max_training=cap, confidence=90.0)
    with stream_session(spark, 2):
        end = end_of(spark)
        stream = scan_stream(spark, path, READINGS, "t", files_per_trigger=files, end=end)
        judged = stream_band(
            series(stream), ["k"], "window_time", "v", config, retire="20 minutes"
        ).select(*KEEP)
        out, checkpoint = shared_dir(spark, "o"), shared_dir(spark, "c")
        first = start_table(judged, out, checkpoint)
        first.awaitTermination()
        end.mark()
        last = start_table(judged, out, checkpoint)
        last.awaitTermination()
        got = scan(spark, out, judged.schema)
        windows = series(scan(spark, path, READINGS)).withColumn(
            "life",
            ((F.col("k") == "y") & (F.col("window_start") >= START + dt.timedelta(minutes=55))),
        )
        expected = detect_anomalies(windows, ["k", "life"], "window_time", "v", config)
        assert as_set(got) == as_set(expected.select(*KEEP))
    kept = [
        [s.numRowsTotal for s in p.stateOperators if "transformWithState" in s.operatorName]
        for job in (first, last)
        for p in job.recentProgress
    ]
    assert max(n for (n,) in kept) > 0
    assert kept[-1] == [0]  # the end of the input silences every key


# --- late rows, rejects ----------------------------------------------------------------


@pytest.mark.parametrize("pauses", [True, False])
def test_late_rows_are_those_a_window_drops(spark, pauses):
    path = shared_dir(spark, "late")
    at = lambda m, s=0: START + dt.timedelta(minutes=m, seconds=s)
    files = [
        [("x", at(0, 10), 1.0, 0.0), ("x", None, 9.0, 0.0)],
        [("x", at(1, 5), 5.0, 0.0)],  # the watermark becomes 1:00
        [("x", at(0, 59), 99.0, 0.0), ("x", at(1, 30), 7.0, 0.0), ("y", at(0, 1), 98.0, 0.0)],
        [("x", at(9), 0.0, 0.0), ("y", at(0, 2), 96.0, 0.0)],
        [("x", at(8, 59), 0.0, 0.0), ("y", at(7), 97.0, 0.0)],
    ]
    accepted, late, marks, checkpoint = (shared_dir(spark, n) for n in "almc")
    out, other = shared_dir(spark, "o"), shared_dir(spark, "c")
    dropped = 0

    def run():
        stream = scan_stream(spark, path, READINGS, files_per_trigger=1)
        split = (accepted, late, marks, checkpoint, pauses)
        start_late_split(stream, "t", "1 minute", "5 seconds", *split).awaitTermination()
        timed = scan_stream(spark, path, READINGS, "t", files_per_trigger=1)
        windows = tumble(timed, "t", "1 minute", ["k"], [F.count(F.lit(1)).alias("n")])
        job = start_table(windows, out, other)
        job.awaitTermination()
        return sum(
            s.numRowsDroppedByWatermark for p in job.recentProgress for s in p.stateOperators
        )

    with stream_session(spark, 2):
        for rows in files:
            write_file(spark, path, rows)
            dropped += run() if pauses else 0
        dropped += 0 if pauses else run()
    schema = schema_of("k string, t timestamp, a double, b double, watermark timestamp")
    found = scan_batches(spark, late, schema).orderBy("a").collect()
    seen = [(r["a"], r["watermark"]) for r in found]
    if pauses:
        assert seen == [(96, at(1, 25)), (97, at(8, 55)), (98, at(1)), (99, at(1))]
    else:
        assert seen == [(96, at(1))]
    assert len(found) == dropped
    assert scan_batches(spark, accepted, READINGS).count() == sum(map(len, files)) - len(found)


def test_every_row_is_accepted_or_rejected_once(spark, telemetry):
    accepted, rejected, checkpoint = (shared_dir(spark, n) for n in "arc")
    with stream_session(spark, 2):
        stream = scan_stream(spark, telemetry, READINGS, files_per_trigger=2)
        for _ in range(2):  # the second start finds nothing new
            start_split(stream, ["a"], accepted, rejected, checkpoint).awaitTermination()
    rows = batch_rows(spark, telemetry)
    good, bad = (scan_batches(spark, p, READINGS) for p in (accepted, rejected))
    assert as_set(good) == as_set(rows.where("a IS NOT NULL"))
    assert as_set(bad) == as_set(rows.where("a IS NULL"))
    assert good.count() + bad.count() == rows.count() and bad.count() > 0


def test_a_retried_batch_goes_on_after_its_finished_steps(spark, telemetry):
    """The second step fails once; the restarted batch does not make the first one's calls."""
    first, second, checkpoint = (shared_dir(spark, n) for n in ("s1", "s2", "c"))
    calls = spark.sparkContext.accumulator(0)
    broken = [True]

    def paid(batch):
        def call(rows):
            for row in rows:
                calls.add(len(row))
                yield row

        return batch.select("k", "t").mapInPandas(call, "k string, t timestamp")

    def fails_once(batch):
        if broken and broken.pop():
            raise RuntimeError("lost")
        return batch.withColumn("done", F.lit(True))

    rows = batch_rows(spark, telemetry).count()
    with stream_session(spark, 2):
        stream = scan_stream(spark, telemetry, READINGS)
        steps = [(first, paid), (second, fails_once)]
        with pytest.raises(Exception, match="lost"):
            start_written_steps(stream, steps, checkpoint).awaitTermination()
        assert calls.value == rows
        start_written_steps(stream, steps, checkpoint).awaitTermination()
    assert spark.read.parquet(second).count() == rows
    assert calls.value == rows


# --- jobs chained by tables ------------------------------------------------------------


def stages():
    return [
        Stage("windows", lambda df: windowed_signals(df, WATCH), "t"),
        Stage("anomalies", lambda df: anomaly_table(window_anomalies(df, WATCH)), "window_time"),
        Stage("at_risk", lambda df: at_risk(df, WATCH), "window_time"),
        Stage("diagnosed", lambda df: diagnose(df, WATCH)),
    ]


def test_stages_stopped_and_started_again(spark):
    """Files arrive while jobs stop between stages; the tables end as the batch job's."""
    path, root = shared_dir(spark, "in"), shared_dir(spark, "stages")
    end = end_of(spark)

    def jobs():  # a new process would build them anew
        source = lambda e: scan_stream(spark, path, READINGS, "t", end=e)
        return StagedTables(source, root, stages(), end)

    with stream_session(spark, 2):
        write_file(spark, path, readings(range(0, 30)))
        jobs().advance(upto="anomalies")  # stopped between the second and the third job
        write_file(spark, path, readings(range(30, 60)))
        jobs().advance()
        write_file(spark, path, readings(range(60, 85)))
        jobs().close()
        got = jobs().table("diagnosed", spark)
        batch = batch_rows(spark, path)
        expected = diagnose(at_risk(signal_anomalies(batch, WATCH), WATCH), WATCH)
        assert as_set(got) == as_set(expected)
        assert got.count() > 0


def test_a_replay_does_not_keep_its_state_open(spark):
    """The stores of all partitions together hold a bounded part of an executor's memory."""
    store = "spark.sql.streaming.stateStore"
    with stream_session(spark, replay=spark.range(9)):
        assert spark.conf.get(f"{store}.rocksdb.boundedMemoryUsage") == "true"
        assert int(spark.conf.get(f"{store}.rocksdb.maxMemoryUsageMB")) <= 256
        assert spark.conf.get(f"{store}.unloadOnCommit") == "true"
    with stream_session(spark):
        assert spark.conf.get(f"{store}.rocksdb.boundedMemoryUsage") == "true"
        assert spark.conf.get(f"{store}.unloadOnCommit") == "false"
