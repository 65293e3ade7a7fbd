"""Pushdown and pruning on the stored tables."""

from conftest import DATA

import __spark_entry__ as entry


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_reads_only_its_columns_once(spark):
    plan = plan_of(entry.queries()["at_risk_entities"](spark, DATA))
    assert plan.count("FileScan parquet") == 1
    assert "l_partkey" not in plan
    assert "PushedFilters: [IsNotNull(l_shipdate)]" in plan
    assert plan.count("Exchange") == 2


def test_entity_filters_reach_the_scan(spark):
    risks = entry.queries()["at_risk_entities"](spark, DATA).where("l_suppkey = 3")
    assert "EqualTo(l_suppkey,3)" in plan_of(risks)


def test_text_queries_stay_in_the_jvm(spark):
    for name in ("parse_diagnosis", "parse_actions", "build_prompt", "dispatch_json"):
        plan = plan_of(entry.queries()[name](spark, DATA))
        assert "Python" not in plan and "Arrow" not in plan


def test_models_get_only_the_prompt(spark):
    plan = plan_of(entry.queries()["ml_predict_rules"](spark, DATA))
    assert plan.count("ArrowEvalPython") == 1
    assert "MapInPandas" not in plan


def test_lookups_do_not_broadcast_by_hint_or_cross(spark):
    for name in ("shop_lookup", "dispatch_policy", "parts_lookup"):
        frame = entry.queries()[name](spark, DATA)
        text = frame._jdf.queryExecution().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "ResolvedHint" not in text


def test_split_detector_scans_the_source_once(spark):
    """Totals and rows come from one stored table of windows, which is no second tumble."""
    for name in ("eda_band", "band_split_mean", "band_split_trend", "band_split_ar1",
                 "band_split_max_training"):
        plan = plan_of(entry.queries()[name](spark, DATA))
        assert "events.parquet" not in plan and "chunks-" in plan
        assert "window(" not in plan.lower() or "PreciseTimestampConversion" not in plan


def test_roll_up_has_state_of_fixed_size(spark):
    for name in ("at_risk_entities", "distinct_signals", "list_signals", "escalate_multi_signal"):
        plan = plan_of(entry.queries()[name](spark, DATA))
        assert "HashAggregate" in plan
        assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
