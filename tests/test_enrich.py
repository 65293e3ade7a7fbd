"""Inference, agents and dispatch rules."""

import json
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from signalguard.operators.dispatch import (
    dispatch_agent,
    dispatch_json,
    dispatch_policy,
    offer_lists,
    parts_for,
    shop_lookup,
)
from signalguard.operators.enrich import (
    AgentSpec,
    RuleModel,
    ToolCall,
    ToolThreads,
    input_fields,
    lateral_apply,
    ml_predict,
    run_agent,
)
from signalguard.operators.ledger import Ledger
from signalguard.schemas import DISPATCH, schema_of
from signalguard.session import shared_dir


# Workers cannot import test modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def counting_model():
    """A model that reports how often it was called, and for how many prompts."""
    calls = []

    def model(prompts: pd.Series) -> pd.Series:
        calls.append(len(prompts))
        return prompts.str.upper() + f"/{len(calls)}/{len(prompts)}"

    return model


def test_predict_batches_and_nulls(spark):
    rows = [(i, None if i == 3 else f"p{i}") for i in range(7)]
    df = spark.createDataFrame(rows, "id int, prompt string").coalesce(1)
    got = {r.id: r.response for r in ml_predict(df, counting_model, "prompt", batch_size=4, tasks=0).collect()}
    assert got[3] is None
    assert [got[i] for i in (0, 1, 2, 4)] == [f"P{i}/1/4" for i in (0, 1, 2, 4)]
    assert [got[i] for i in (5, 6)] == [f"P{i}/2/2" for i in (5, 6)]


def test_predict_spreads_over_tasks(spark):
    df = spark.range(40).select(F.col("id").cast("string").alias("prompt")).coalesce(1)
    tasks = [
        ml_predict(df, counting_model, "prompt", tasks=n)
        .select(F.spark_partition_id().alias("p"), "response")
        .groupBy("p")
        .count()
        .collect()
        for n in (0, 3, None)
    ]
    cores = spark.sparkContext.defaultParallelism
    assert [len(t) for t in tasks] == [1, 3, cores]
    counts = [r["count"] for r in tasks[2]]
    assert sum(counts) == 40 and max(counts) - min(counts) <= cores


def test_rule_model():
    prompts = pd.Series(
        [
            "Outside the band: a, b (2 distinct signals)\n",
            "Outside the band: a, b, c, d, e (5 distinct signals)\n",
            "nothing",
        ]
    )
    answers = RuleModel()(prompts)
    assert answers[0].startswith("SEVERITY: MEDIUM\nLIKELY_CAUSE: joint fault behind a, b\n")
    assert answers[1].startswith("SEVERITY: CRITICAL")
    assert answers[2].startswith("SEVERITY: LOW\nLIKELY_CAUSE: joint fault behind unknown")


def test_lateral_apply_keeps_rows_in_place(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bb")], "id int, t string")
    out = lateral_apply(
        df, lambda b: pd.DataFrame({"n": b["t"].str.len()}), schema_of("n bigint")
    )
    assert sorted(map(tuple, out.collect())) == [(1, "a", 1), (2, "bb", 2)]
    short = lateral_apply(df.coalesce(1), lambda b: pd.DataFrame({"n": [1]}), schema_of("n bigint"))
    with pytest.raises(Exception, match="one row per input row"):
        short.collect()


def step_forever(instructions, text, key, seen):
    return ToolCall("count", {"n": len(seen)})


def step_report(instructions, text, key, seen):
    names = ("good", "bad", "forbidden")
    if len(seen) < len(names):
        return ToolCall(names[len(seen)], {"text": text})
    return " | ".join(f"{s.call.name}:{s.ok}:{s.text}" for s in seen)


def good(arguments, key, timeout):
    return f"{arguments['text']}/{key}/{timeout:g}"


def bad(arguments, key, timeout):
    raise TimeoutError("no answer")


def test_agent_stops_at_the_limit():
    calls = []
    spec = AgentSpec("a", step_forever, {"count": lambda a, k, t: calls.append(a) or "x"}, "", 4)
    assert spec.run("t", "k") is None
    assert [c["n"] for c in calls] == [0, 1, 2, 3]


@pytest.mark.parametrize("concurrency", [1, 3])
def test_agent_survives_failing_and_forbidden_tools(spark, concurrency):
    spec = AgentSpec("a", step_report, {"good": good, "bad": bad}, request_timeout=30.0)
    df = spark.createDataFrame([("x", "k1"), (None, "k2"), ("y", "k3")], "t string, k string")
    got = {r.k: r.response for r in run_agent(df, spec, "t", "k", concurrency=concurrency).collect()}
    tail = "bad:False:TimeoutError: no answer | forbidden:False:tool forbidden is not allowed"
    assert got == {
        "k1": f"good:True:x/k1/30 | {tail}",
        "k2": None,
        "k3": f"good:True:y/k3/30 | {tail}",
    }


def agent_text(severity, cause):
    return f"truck_id: TRK-1, severity: {severity}, likely_cause: {cause}, recommended_action: go"


def order_of(report: str) -> dict:
    return json.loads(report.split("Dispatch JSON:\n")[1].split("\n\nAPI Response:")[0])


def shops(arguments, key, timeout):
    return json.dumps(
        [
            {"shop_id": "FAR", "miles": 120, "specialty": "vibration"},
            {"shop_id": "NEAR", "miles": 30, "specialty": "engine_temp"},
        ]
    )


@pytest.mark.parametrize(
    ("severity", "cause", "status", "shop", "miles", "parts"),
    [
        ("CRITICAL", "vibration", "URGENT", "NEAR", 30, ["wheel bearing kit"]),
        ("HIGH", "vibration, rising", "PRIORITY", "FAR", 120, ["wheel bearing kit"]),
        ("high", "brakes", "PRIORITY", "NEAR", 30, []),
        ("MEDIUM", "engine_temp", "SCHEDULED", "NEAR", 30, ["coolant pump"]),
        ("LOW", "oil_pressure", "MONITOR", None, None, ["oil pump seal kit"]),
    ],
)
def test_dispatcher_with_tools(severity, cause, status, shop, miles, parts):
    posted = []
    agent = dispatch_agent(shops, lambda a, key, t: posted.append((key, a["body"])) or "201")
    report = agent.run(agent_text(severity, cause), "key-1")
    order = order_of(report)
    assert (order["status"], order["shop_id"], order["eta_miles"]) == (status, shop, miles)
    assert order["parts_to_pre_stage"] == parts and order["diagnosis"] == cause
    assert report.endswith("API Response:\n201")
    assert [p[0] for p in posted] == ["key-1"] and posted[0][1] == order


def test_dispatcher_without_tools():
    report = dispatch_agent().run(agent_text("CRITICAL", "vibration"), "k")
    order = order_of(report)
    assert order["shop_id"] == "SHOP-AUSTIN" and order["eta_miles"] is None
    assert report.endswith("API Response:\nMOCKED: 200 OK")
    assert list(order) == DISPATCH.fieldNames()


def test_input_fields():
    assert input_fields("a: 1, b: x, y, c_d: ") == {"a": "1", "b": "x, y", "c_d": ""}


def test_shop_lookup_limits_and_specialties(spark):
    rows = [
        (1, "t1", "CRITICAL", "vibration"),
        (2, "t1", "HIGH", "vibration"),
        (3, "t1", "LOW", "vibration"),
        (4, "t2", "CRITICAL", "engine_temp"),
        (5, "t2", "MEDIUM", "engine_temp"),
        (6, "t3", "HIGH", None),
        (7, "t1", "strange", "vibration"),
        (8, None, "CRITICAL", "vibration"),
    ]
    df = spark.createDataFrame(rows, "id int, e string, severity string, likely_cause string")
    centers = spark.createDataFrame(
        [
            ("t1", "A", 10, "engine_temp"),
            ("t1", "B", 90, "vibration"),
            ("t2", "C", 70, "engine_temp"),
        ],
        "e string, shop_id string, miles int, specialty string",
    )
    found = shop_lookup(dispatch_policy(df), centers, "e", specialty="specialty")
    got = {r.id: (r.status, r.shop_id, r.eta_miles) for r in found.collect()}
    assert got == {
        1: ("URGENT", "A", 10),
        2: ("PRIORITY", "B", 90),
        3: ("MONITOR", None, None),
        4: ("URGENT", "SHOP-AUSTIN", None),
        5: ("SCHEDULED", "C", 70),
        6: ("PRIORITY", "SHOP-AUSTIN", None),
        7: (None, None, None),
        8: ("URGENT", "SHOP-AUSTIN", None),
    }


def test_dispatch_json_has_eight_fields(spark):
    df = spark.createDataFrame(
        [("t1", "low", "no fault", None, None)],
        "e string, severity string, likely_cause string, shop_id string, eta_miles int",
    )
    df = dispatch_policy(df).withColumn("parts_to_pre_stage", parts_for(F.col("likely_cause")))
    order = json.loads(df.select(dispatch_json("e").alias("j")).first().j)
    assert list(order) == DISPATCH.fieldNames()
    assert order["severity"] == "LOW" and order["shop_id"] is None
    assert order["parts_to_pre_stage"] == []


def test_a_tool_that_is_not_allowed_is_no_silence():
    spec = AgentSpec("a", None, {"here": good})
    seen = spec.use(ToolCall("elsewhere", {}), "k")
    assert not seen.ok and seen.reachable
    missing = AgentSpec("a", None, {"read": lambda a, k, t: open("/no/such/file").read()})
    assert missing.use(ToolCall("read", {}), "k").reachable  # our fault, nobody's silence


def test_an_order_without_an_answer_in_time_is_unknown():
    def late(arguments, key, timeout):
        raise TimeoutError("no answer")

    answer = dispatch_agent(shops, late).run(agent_text("CRITICAL", "vibration"), "k")
    assert answer.endswith("UNKNOWN: TimeoutError: no answer")


def test_hung_calls_cost_threads_and_not_the_task():
    import threading

    wait = threading.Event()
    threads = ToolThreads(2)
    for _ in range(5):
        with pytest.raises(TimeoutError):
            threads.call(lambda a: wait.wait(20), {}, timeout=0.05)
    assert threads.call(lambda a: "ok", {}, timeout=5) == "ok"
    wait.set()
    threads.close()


def test_replies_from_columns(spark):
    spec = AgentSpec("a", step_report, {"good": good}, request_timeout=30.0)
    df = spark.createDataFrame([("x", "k1", "table"), ("y", "k2", None)], "t string, k string, r string")
    got = run_agent(df, spec, "t", "k", concurrency=2, replies={"bad": "r"})
    answers = {r.k: r.response.split(" | ")[1] for r in got.collect()}
    assert answers == {"k1": "bad:True:table", "k2": "bad:False:nothing is known"}


def test_offer_lists_hold_all_the_dispatcher_can_choose(spark):
    rows = [("t", f"S{i % 9}", None if i == 5 else float(i * 37 % 50), ["vibration", "x", None][i % 3])
            for i in range(40)]
    centers = spark.createDataFrame(rows, "e string, shop_id string, miles double, specialty string")
    (row,) = offer_lists(centers, "e").collect()
    offers = json.loads(row.offers)
    assert 1 <= len(offers) <= 4
    whole = json.dumps([{"shop_id": s, "miles": m, "specialty": p} for _, s, m, p in rows])
    for severity in ("CRITICAL", "HIGH", "MEDIUM"):
        text = agent_text(severity, "vibration")
        short = dispatch_agent(lambda a, k, t: row.offers, good).run(text, "k")
        full = dispatch_agent(lambda a, k, t: whole, good).run(text, "k")
        assert order_of(short) == order_of(full)


def test_ledger_calls_each_key_once(spark):
    path = shared_dir(spark, "ledger")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, k string")

    def run(rows, delivery):
        calls = spark.sparkContext.accumulator(0)

        def call(todo):
            asked = todo.withColumn("out", F.concat(F.lit(f"{delivery}:"), "k"))
            calls.add(asked.count())
            return asked

        found = Ledger(spark, path, delivery).call(rows, F.col("k"), call, "out")
        return {r.id: r.out for r in found.collect()}, calls.value

    assert run(df.where("id = 2"), 0) == ({2: "0:b"}, 1)
    # A retried and wider delivery: b is not called again, the two rows of a share a call.
    assert run(df, 1) == ({1: "1:a", 2: "0:b", 3: "1:a", 4: None}, 1)
    assert run(df, 2) == ({1: "1:a", 2: "0:b", 3: "1:a", 4: None}, 0)
    assert Ledger(spark, path).rows().count() == 2


def test_tools_that_never_wait_need_no_thread():
    class NoThreads:
        def call(self, *_, **__):
            raise AssertionError("a thread was asked for")

    text = "truck_id: 7, severity: HIGH, likely_cause: coolant leak, recommended_action: stop"
    answer = dispatch_agent().run(text, "7_1", threads=NoThreads())
    assert answer == dispatch_agent().run(text, "7_1")
    assert answer.endswith("API Response:\nMOCKED: 200 OK")
    waiting = dispatch_agent(http_post=lambda arguments, key, timeout: "201")
    assert "FAILED" in waiting.run(text, "7_1", threads=NoThreads())
