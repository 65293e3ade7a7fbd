"""One entity holds a third of all readings: same result, and no task gets its rows raw."""

import re

import pytest
from pyspark.sql import functions as F

from signalguard.operators.detect import BandConfig, detect_anomalies, detect_signals
from signalguard.operators.windows import average_signals
from signalguard.plans.stages import Watch, at_risk, signal_anomalies

LABELS = {"a": ("A", 1, "0"), "b": ("B", 1, "0")}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """90,000 readings over 500 minutes; entity 0 has every third one."""
    i = F.col("id")
    noise = (F.hash(i) % 1000) / 100.0
    spike = F.when(F.hash(i + 7) % 900 == 0, 4000.0).otherwise(0.0)
    return spark.range(90_000).select(
        F.when(i % 3 == 0, 0).otherwise(i % 40).alias("k"),
        F.timestamp_seconds(F.floor(i / 3)).alias("t"),
        (noise + spike).alias("a"),
        (noise * 2 + spike).alias("b"),
    )


def test_readings_are_combined_before_the_shuffle(hot):
    plan = plan_of(average_signals(hot, "t", "1 minute", "k", ["a", "b"]))
    assert plan.count("Exchange") == 1
    assert re.search(r"Exchange hashpartitioning[\s\S]*HashAggregate[\s\S]*partial_avg", plan)


def test_whole_batch_job_has_two_exchanges(hot):
    """One for the windows, one on the entity, which also serves the roll-up."""
    watch = Watch("k", "t", LABELS, band=BandConfig(min_training=20))
    plan = plan_of(at_risk(signal_anomalies(hot, watch), watch))
    assert plan.count("Exchange") == 2
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("cap", [None, 50])
def test_split_and_wide_plans_agree_on_a_hot_entity(hot, cap):
    config = BandConfig(min_training=20, max_training=cap, confidence=95.0)
    wide = average_signals(hot, "t", "1 minute", "k", ["a", "b"])
    results = []
    for span in (None, "1 hour"):
        rows = detect_signals(wide, ["k"], "window_time", ["a", "b"], config, history_span=span)
        results.append(rows)
    long = wide.unpivot(["k", "window_time"], ["a", "b"], "signal", "observed_value")
    results.append(
        detect_anomalies(long, ["k", "signal"], "window_time", "observed_value", config)
    )
    found = [
        {
            (r.k, r.window_time, r.signal, r.r.is_anomaly, r.r.training_size)
            for r in df.select("k", "window_time", "signal", "r").collect()
        }
        for df in results
    ]
    assert found[0] == found[1] == found[2]
    assert any(row[3] for row in found[0])


def test_chunks_bound_what_a_task_holds(hot):
    """With a span no window is partitioned by the entity alone, but over chunk totals."""
    config = BandConfig(min_training=20, max_training=None)
    wide = average_signals(hot, "t", "1 minute", "k", ["a"])
    plan = plan_of(
        detect_anomalies(wide, ["k"], "window_time", "a", config, history_span="1 hour")
    )
    rows_side = [line for line in plan.splitlines() if "Window [" in line and "_sum0" not in line]
    assert rows_side and all("_chunk" in line for line in rows_side)


def test_bands_are_judged_in_small_tasks(spark, hot):
    """However few partitions a shuffle makes, a task sorts few entities' rows."""
    wide = average_signals(hot, "t", "1 minute", "k", ["a", "b"])
    judged = detect_signals(wide, ["k"], "window_time", ["a", "b"], BandConfig(min_training=20))
    cores = spark.sparkContext.defaultParallelism
    assert re.search(rf"Exchange hashpartitioning\(k#\d+L?, {8 * cores}\)", plan_of(judged))
    assert plan_of(judged).count("Exchange") == 2
