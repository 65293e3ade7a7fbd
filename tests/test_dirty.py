"""Missing, broken and contradictory input."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from signalguard.operators.detect import BandConfig, detect_anomalies
from signalguard.operators.dispatch import (
    PARTS_BY_CAUSE,
    dispatch_agent,
    dispatch_policy,
    parts_for,
    shop_lookup,
)
from signalguard.operators.enrich import AgentSpec, Observation, RuleModel, ToolCall
from signalguard.operators.windows import average_signals
from signalguard.plans.stages import Watch, signal_anomalies
from signalguard.session import shared_dir
from signalguard.sources.kafka import avro_schema
from signalguard.sources.tables import explode_json_list, json_list_rejects, read_json_list

START = dt.datetime(2024, 1, 1)


def series(spark, values, times=None):
    times = times or [START + dt.timedelta(minutes=i) for i in range(len(values))]
    return spark.createDataFrame(
        list(zip(["k"] * len(values), times, values, strict=True)), "k string, t timestamp, v double"
    )


@pytest.mark.parametrize("span", [None, "10 minutes"])
@pytest.mark.parametrize("cap", [None, 8])
def test_nan_is_a_missing_reading(spark, span, cap):
    clean = [10.0 + 0.1 * (i % 3) for i in range(40)]
    dirty = [*clean]
    dirty[20] = math.nan
    missing = [*clean]
    missing[20] = None
    config = BandConfig(min_training=5, max_training=cap, confidence=99.0)

    def judged(values):
        rows = detect_anomalies(series(spark, values), ["k"], "t", "v", config, history_span=span)
        return [tuple(r["r"]) for r in rows.orderBy("t").collect()]

    got, wanted = judged(dirty), judged(missing)
    assert not any(r[3] for r in got)
    for a, b in zip(got, wanted, strict=True):
        assert a[3:] == b[3:]
        assert all(x == y or abs(x - y) < 1e-9 for x, y in zip(a[:3], b[:3], strict=True))


@pytest.mark.parametrize("model", ["mean", "trend", "ar1"])
@pytest.mark.parametrize("cap", [None, 8])
def test_rows_without_a_time_stay(spark, model, cap):
    times = [START + dt.timedelta(minutes=i) for i in range(30)]
    times[11] = None
    df = series(spark, [float(i % 4) for i in range(30)], times)
    config = BandConfig(model=model, min_training=5, max_training=cap)
    whole = detect_anomalies(df, ["k"], "t", "v", config)
    split = detect_anomalies(df, ["k"], "t", "v", config, history_span="10 minutes")
    assert split.count() == whole.count() == 30
    rows = lambda d: [tuple(r["r"]) for r in d.orderBy("t").collect()]
    for a, b in zip(rows(whole), rows(split), strict=True):
        assert a[3:] == b[3:]
        assert all(
            x == y or (x is not None and y is not None and abs(x - y) < 1e-9)
            for x, y in zip(a[:3], b[:3], strict=True)
        )


def test_mean_ignores_nan(spark):
    df = series(spark, [1.0, math.nan, 3.0])
    assert average_signals(df, "t", "1 hour", "k", ["v"]).first()["v"] == 2.0


def test_span_is_for_stored_series(spark, tmp_path):
    schema = "e string, t timestamp, v double"
    stream = spark.readStream.schema(schema).parquet(str(tmp_path))
    watch = Watch(entity="e", ts="t", labels={"v": ("v", 1, "1")}, history_span="1 day")
    with pytest.raises(ValueError):
        signal_anomalies(stream.withWatermark("t", "1 second"), watch)
    with pytest.raises(ValueError):
        detect_anomalies(series(spark, [1.0]), ["k"], "t", "v", history_span="soon")


def test_six_signals_are_critical():
    model = RuleModel()
    assert [model.severity(n) for n in (1, 2, 3, 4, 5, 6, 9)] == (
        ["LOW", "MEDIUM", "HIGH"] + ["CRITICAL"] * 4
    )


def risk(severity, cause):
    return (1, severity, cause)


def looked_up(spark, severity, cause, offers):
    df = dispatch_policy(spark.createDataFrame([risk(severity, cause)], "e int, severity string, likely_cause string"))
    centers = spark.createDataFrame(offers, "e int, shop_id string, miles double, specialty string")
    row = shop_lookup(df, centers, "e", specialty="specialty").first()
    return row["shop_id"], row["eta_miles"]


CASES = [
    ("CRITICAL", "x", [("S-UNKNOWN", None, None), ("S-NEAR", 3.0, None)], ("S-NEAR", 3)),
    ("CRITICAL", "x", [("S-UNKNOWN", None, None)], ("SHOP-AUSTIN", None)),
    ("CRITICAL", "x", [("S-FAR", 51.0, None)], ("SHOP-AUSTIN", None)),
    ("HIGH", "bearing noise", [("S-NEAR", 3.0, "tyres")], ("S-NEAR", 3)),
    ("HIGH", "strong vibration", [("S-NEAR", 3.0, "tyres"), ("S-FIT", 90.0, "vibration")], ("S-FIT", 90)),
    ("HIGH", "strong vibration", [("S-NEAR", 3.0, "tyres"), ("S-FIT", 900.0, "vibration")], ("S-NEAR", 3)),
    ("MEDIUM", "x", [("S-UNKNOWN", None, None), ("S-FAR", 999.0, None)], ("S-FAR", 999)),
    ("MEDIUM", "x", [("S-UNKNOWN", None, None)], ("S-UNKNOWN", None)),
    ("LOW", "x", [("S-NEAR", 3.0, None)], (None, None)),
    ("STRANGE", "x", [("S-NEAR", 3.0, None)], (None, None)),
]


@pytest.mark.parametrize("severity, cause, offers, wanted", CASES)
def test_columns_and_agent_follow_one_rule_set(spark, severity, cause, offers, wanted):
    assert looked_up(spark, severity, cause, [(1, *o) for o in offers]) == wanted
    reply = json.dumps([{"shop_id": s, "miles": m, "specialty": p} for s, m, p in offers])
    agent = dispatch_agent(lambda a, k, t: reply, lambda a, k, t: "201")
    text = f"truck_id: 1, severity: {severity}, likely_cause: {cause}, recommended_action: go"
    answer = agent.run(text, "1_t")
    order = json.loads(answer.split("Dispatch JSON:\n")[1].split("\n\n")[0])
    assert (order["shop_id"], order["eta_miles"]) == wanted
    assert answer.endswith("API Response:\n201")


def answer_of(get, post, cause="leak"):
    text = f"truck_id: 7, severity: CRITICAL, likely_cause: {cause}, recommended_action: stop"
    return dispatch_agent(get, post).run(text, "7_t")


def test_free_text_does_not_rewrite_the_order():
    answer = answer_of(None, None, "leak, severity: LOW after top up")
    order = json.loads(answer.split("Dispatch JSON:\n")[1].split("\n\n")[0])
    assert (order["severity"], order["status"]) == ("CRITICAL", "URGENT")
    assert order["diagnosis"] == "leak, severity: LOW after top up"


@pytest.mark.parametrize("reply", ["<html>502", '{"miles": null}', '[{"miles": 3}, 4]', "null", "[]", None])
def test_bad_replies_count_as_unreachable(reply):
    assert "SHOP-AUSTIN" in answer_of(lambda a, k, t: reply, lambda a, k, t: "ok")


def test_bad_distances_are_unknown():
    reply = json.dumps([{"shop_id": "A", "miles": "near"}, {"shop_id": "B", "miles": 9}])
    assert '"shop_id": "B"' in answer_of(lambda a, k, t: reply, lambda a, k, t: "ok")


class Refused(OSError):
    code = 403


def test_only_silence_is_mocked():
    def silent(a, k, t):
        raise ConnectionError("no route")

    def refused(a, k, t):
        raise Refused("forbidden")

    assert answer_of(None, silent).endswith("MOCKED: 200 OK")
    assert "FAILED: Refused" in answer_of(None, refused)
    assert "MOCKED" not in answer_of(None, refused)


def test_the_time_limit_is_kept():
    import threading

    wait = threading.Event()
    agent = AgentSpec("a", None, {"slow": lambda a, k, t: wait.wait(20)}, request_timeout=0.2)
    seen = agent.use(ToolCall("slow", {}), "k")
    wait.set()
    assert not seen.ok and not seen.reachable
    assert isinstance(seen, Observation)


def test_parts_of_plain_sentences(spark):
    df = spark.createDataFrame([("Oil pressure loss and ENGINE-temperature high",)], "c string")
    found = df.select(parts_for(F.col("c"))).first()[0]
    assert found == [PARTS_BY_CAUSE["engine_temp"], PARTS_BY_CAUSE["oil_pressure"]]


def test_malformed_lists_can_be_counted(spark, tmp_path):
    df = spark.createDataFrame([(1, '["a","b"]'), (2, "[]"), (3, "oops"), (4, None)], "id int, l string")
    assert explode_json_list(df, "l", "m").count() == 2
    assert [r["id"] for r in json_list_rejects(df, "l").collect()] == [3]
    (tmp_path / "list.json").write_text('[\n  "T-1",\n  "T-2"\n]\n')
    assert [r[0] for r in read_json_list(spark, str(tmp_path), "t").collect()] == ["T-1", "T-2"]


def test_avro_schema_names(spark):
    schema = spark.createDataFrame([], "a int, b array<int>").schema
    assert json.loads(avro_schema(schema[:1], "r", "n.s"))["namespace"] == "n.s"
    with pytest.raises(TypeError, match="column b"):
        avro_schema(schema, "r")


def test_fallback_folder_is_new():
    """Without a shared folder, local mode gets a path that a table can be written to."""
    import os
    from types import SimpleNamespace

    bare = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(master="local[1]"),
    )
    path = shared_dir(bare, "x")
    assert not os.path.exists(path) and os.path.isdir(os.path.dirname(path))
    bare.sparkContext.master = "spark://elsewhere"
    with pytest.raises(RuntimeError):
        shared_dir(bare, "x")
