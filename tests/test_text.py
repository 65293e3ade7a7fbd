"""Prompts, sections and scalar helpers on golden texts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from signalguard.functions.scalar import extract_or_null, hours_since, round_half_up, to_millis
from signalguard.functions.text import (
    ACTION_SECTIONS,
    DIAGNOSIS_SECTIONS,
    agent_input,
    diagnosis_prompt,
    parse_sections,
)

WELL_FORMED = (
    "SEVERITY: HIGH\nLIKELY_CAUSE: bearing wear\nRECOMMENDED_ACTION: inspect the front axle"
)


@pytest.mark.parametrize(
    ("text", "severity", "cause", "action"),
    [
        (WELL_FORMED, "HIGH", "bearing wear", "inspect the front axle"),
        (
            "severity: high\nlikely_cause: leak\nrecommended_action: refill",
            "high",
            "leak",
            "refill",
        ),
        ("SEVERITY: LOW\nLIKELY_CAUSE: cut off", "LOW", None, None),
        ("SEVERITY: LOW\nLIKELY_CAUSE: cut off\n", "LOW", "cut off", None),
        ("SEVERITY: SEVERE\nLIKELY_CAUSE: a\nRECOMMENDED_ACTION: b", None, "a", "b"),
        (
            "SEVERITY: MEDIUM\nLIKELY_CAUSE: one\nand two\n  RECOMMENDED_ACTION: go",
            "MEDIUM",
            "one\nand two",
            "go",
        ),
        (WELL_FORMED + "\n", "HIGH", "bearing wear", "inspect the front axle"),
        ("", None, None, None),
        (None, None, None, None),
    ],
)
def test_diagnosis_sections(spark, text, severity, cause, action):
    df = spark.createDataFrame([(text,)], "a string")
    row = parse_sections(df, "a", DIAGNOSIS_SECTIONS).first()
    assert (row.severity, row.likely_cause, row.recommended_action) == (severity, cause, action)


def report(mark="", gap="\n\n", json_text='{"a": 1}', api="200 OK"):
    return (
        f"{mark}Dispatch Summary:{mark}\nGo now.{gap}{mark}Dispatch JSON:{mark}\n{json_text}\n\n"
        f"{mark}API Response:{mark}\n{api}"
    )


@pytest.mark.parametrize(
    ("text", "summary", "order", "api"),
    [
        (report(), "Go now.", '{"a": 1}', "200 OK"),
        (report(mark="**"), "Go now.", '{"a": 1}', "200 OK"),
        (report(json_text='```json\n{"a": 1}\n```'), "Go now.", '{"a": 1}\n', "200 OK"),
        (report(gap="\n"), None, '{"a": 1}', "200 OK"),
        (report(api='```json\n{"ok": true}\n```'), "Go now.", '{"a": 1}', '{"ok": true}\n'),
        ("Dispatch Summary:\nGo.\n\nDispatch JSON:\n{}", "Go.", None, None),
        (None, None, None, None),
    ],
)
def test_action_sections(spark, text, summary, order, api):
    df = spark.createDataFrame([(text,)], "a string")
    row = parse_sections(df, "a", ACTION_SECTIONS).first()
    assert (row.dispatch_summary, row.dispatch_json, row.api_response) == (summary, order, api)


def test_no_match_is_null_and_an_empty_match_is_empty(spark):
    df = spark.createDataFrame([("k=",), ("k=v",), ("x",)], "a string")
    found = df.select(extract_or_null(F.col("a"), "k=(v?)", 1).alias("v")).collect()
    assert [r.v for r in found] == ["", "v", None]


RISK = (
    "truck_id string, window_start timestamp, signals_tripped bigint, tripped_signals string, "
    "engine_temp_c double, oil_pressure_psi double, vibration_g double, tire_psi_avg double, "
    "fuel_efficiency_mpg double, severity string, likely_cause string, recommended_action string"
)
SENSORS = [
    "engine_temp_c",
    "oil_pressure_psi",
    "vibration_g",
    "tire_psi_avg",
    "fuel_efficiency_mpg",
]


def risk(*sensors):
    start = dt.datetime(2024, 1, 1)
    return ("TRK-1", start, 2, "engine_temp_c, vibration_g", *sensors, None, None, None)


@pytest.fixture(scope="module")
def risks(spark):
    full = risk(101.26, 40.0, 0.7126, 99.0, 6.5)
    partial = risk(101.26, None, 0.7126, None, None)
    return spark.createDataFrame([full, partial], RISK)


def test_a_missing_sensor_empties_the_strict_text_only(risks):
    strict = diagnosis_prompt("truck_id", null_text=None)
    texts = risks.select(
        strict.alias("strict"),
        diagnosis_prompt("truck_id").alias("safe"),
        agent_input("truck_id", SENSORS).alias("agent_strict"),
        agent_input("truck_id", SENSORS, null_text="n/a").alias("agent_safe"),
    ).collect()
    full, partial = texts
    assert full.strict == full.safe
    assert partial.strict is None and partial.agent_strict is None
    assert "Engine temperature (C): 101.3 (normal near 88)\n" in partial.safe
    assert "Vibration (g): 0.713 " in partial.safe
    assert "Oil pressure (psi): n/a " in partial.safe
    assert full.agent_strict.startswith(
        "truck_id: TRK-1, severity: UNKNOWN, likely_cause: , recommended_action: , "
        "engine_temp_c: 101.26, oil_pressure_psi: 40.0"
    )
    assert partial.agent_safe.endswith("tire_psi_avg: n/a, fuel_efficiency_mpg: n/a")


def test_rounding_and_times(spark):
    df = spark.sql(
        "SELECT 54192.12499999999D AS noisy, 98.25D AS tie, "
        "TIMESTAMP_NTZ '2024-01-02 06:30:00.123456' AS t"
    )
    row = df.select(
        round_half_up(F.col("noisy"), 2).alias("noisy"),
        round_half_up(F.col("tie"), 1).alias("tie"),
        to_millis(df, "t").alias("ms"),
        hours_since(df, "t", "2024-01-01 00:00:00").alias("h"),
    )
    assert dict(row.dtypes)["ms"] == "timestamp_ntz"
    row = row.first()
    assert (row.noisy, row.tie) == (54192.13, 98.3)
    assert row.ms == dt.datetime(2024, 1, 2, 6, 30, 0, 123000)
    assert row.h == pytest.approx(30.5 + 0.123456 / 3600, abs=1e-12)
