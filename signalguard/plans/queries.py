"""Every operator as a query over the shared test tables.

Two tables stand in for telemetry: ``events`` is long (one value per row, entity
``user_id``, signal ``event_type``), ``lineitem`` is wide (entity ``l_suppkey``, four
signals, time ``l_shipdate``).  ``SQL`` in ``plans/oracles.py`` answers the same questions.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalguard.functions.scalar import (
    direction_label,
    extract_or_null,
    json_text,
    minus_seconds,
    round_half_up,
    to_millis,
)
from signalguard.functions.text import (
    ACTION_SECTIONS,
    DIAGNOSIS_SECTIONS,
    Field,
    agent_input,
    build_prompt,
    diagnosis_prompt,
    invocation_key,
    parse_sections,
)
from signalguard.operators.detect import (
    BandConfig,
    anomaly_records,
    detect_anomalies,
    union_branches,
)
from signalguard.operators.dispatch import (
    dispatch_agent,
    dispatch_json,
    dispatch_policy,
    offer_lists,
    parts_for,
    shop_lookup,
)
from signalguard.operators.enrich import RuleModel, lateral_apply, ml_predict
from signalguard.operators.escalate import (
    distinct_signals,
    escalate,
    list_signals,
    signal_pivot,
)
from signalguard.operators.ledger import Ledger
from signalguard.operators.windows import (
    average_signals,
    public_window_time,
    running_frame,
    tumble,
    window_profile,
)
from signalguard.plans.stages import (
    Watch,
    act,
    anomaly_table,
    at_risk,
    diagnose,
    signal_anomalies,
    signal_series,
    window_anomalies,
    windowed_signals,
)
from signalguard.schemas import schema_of
from signalguard.session import shared_dir
from signalguard.sources.tables import (
    EndOfInput,
    all_set,
    append_to_table,
    create_table_as,
    explode_json_list,
    require_not_null,
    scan,
    scan_stream,
    split_not_null,
)
from signalguard.streaming.band import band_seed, stream_band
from signalguard.streaming.late import start_late_split
from signalguard.streaming.run import (
    drain,
    run_to_end,
    scan_batches,
    start_split,
    start_written_steps,
    stream_session,
)
from signalguard.streaming.staged import Stage, StagedTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENTS_TEXT = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
EVENTS = schema_of(EVENTS_TEXT)
LINEITEM = schema_of(
    "l_suppkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_shipdate timestamp_ntz"
)
ACTIONS = schema_of(
    "l_suppkey string, window_start timestamp_ntz, severity string, likely_cause string, "
    "recommended_action string, dispatch_summary string, dispatch_json string, "
    "api_response string, raw_response string"
)
CONVERSATIONS = schema_of("conv_id bigint, turn bigint, role string, text string")

EVENT_SIGNALS = ("click", "error", "purchase", "signup", "view")
LINE_LABELS = {
    "l_quantity": ("Quantity", 1, "25.5"),
    "l_extendedprice": ("Price", 2, "52000"),
    "l_discount": ("Discount", 4, "0.05"),
    "l_tax": ("Tax", 4, "0.04"),
}
LINE_SIGNALS = tuple(LINE_LABELS)

EVENT_BAND = BandConfig(min_training=5, max_training=None)
LINE_BAND = BandConfig(confidence=90.0)
LINE_WATCH = Watch(
    entity="l_suppkey",
    ts="l_shipdate",
    labels=LINE_LABELS,
    width="1 day",
    band=LINE_BAND,
    rollup="30 days",
    sparse=True,
)


def query(function: Query) -> Query:
    """Register under the function's name; ``_rows`` only keeps it apart from an operator."""
    QUERIES[function.__name__.removesuffix("_rows")] = function
    return function


# --- inputs --------------------------------------------------------------------------


def events(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, f"{sf}/events.parquet", EVENTS)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, f"{sf}/lineitem.parquet", LINEITEM)


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return scan(spark, f"{sf}/conversations.parquet", CONVERSATIONS)


def event_series(spark: SparkSession, sf: str, width: str = "1 day") -> DataFrame:
    """One row per user, event type and window."""
    return tumble(
        events(spark, sf).withColumnRenamed("event_type", "signal"),
        "ts",
        width,
        ["user_id", "signal"],
        [F.avg("value").alias("observed_value")],
    )


def event_bands(df: DataFrame, config: BandConfig = EVENT_BAND, **options) -> DataFrame:
    return detect_anomalies(
        df, ["user_id", "signal"], "window_time", "observed_value", config, **options
    )


def event_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly_records(
        event_bands(event_series(spark, sf)), ["user_id", "window_time", "signal"]
    )


def line_series(spark: SparkSession, sf: str) -> DataFrame:
    return signal_series(lines(spark, sf), LINE_WATCH)


def line_risks(spark: SparkSession, sf: str) -> DataFrame:
    return at_risk(signal_anomalies(lines(spark, sf), LINE_WATCH), LINE_WATCH)


def stored_risks(spark: SparkSession, sf: str) -> DataFrame:
    """Escalated rows read from a table, as the later stages do."""
    return create_table_as(line_risks(spark, sf), shared_dir(spark, "at_risk"))


# --- outputs -------------------------------------------------------------------------


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six digits, so that two engines can be compared."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            round_half_up(F.col(c), 6).alias(c) if kinds[c] == "double" else F.col(c)
            for c in df.columns
        ]
    )


def shown(df: DataFrame) -> DataFrame:
    if "window_time" in df.columns:
        df = df.withColumn("window_time", public_window_time())
    return rounded(df)


def band_rows(df: DataFrame, keys: tuple[str, ...] = ("user_id", "signal")) -> DataFrame:
    return shown(df.select(*keys, "window_time", "observed_value", "r.*"))


# --- sources and sinks ---------------------------------------------------------------


@query
def scan_telemetry(spark, sf):
    return events(spark, sf)


GAPPY_COLUMNS = ["value", "event_type", "ts"]


def _gappy(spark, sf) -> DataFrame:
    return _gappy_columns(events(spark, sf))


def _gappy_columns(df: DataFrame) -> DataFrame:
    """Events whose value is missing when it is large, and whose type is when it is small."""
    return df.select(
        "event_id",
        F.when(F.col("value") < 60, F.col("value")).alias("value"),
        F.when(F.col("value") > 1, F.col("event_type")).alias("event_type"),
        "ts",
    )


@query
def require_not_null_rows(spark, sf):
    return require_not_null(_gappy(spark, sf), GAPPY_COLUMNS)


@query
def rejects(spark, sf):
    _, rejected = split_not_null(_gappy(spark, sf), GAPPY_COLUMNS)
    return rejected


@query
def not_null_report(spark, sf):
    """Accepted and rejected rows per day, in one pass over the table."""
    checked = _gappy(spark, sf).withColumn(
        "accepted", all_set(["value", "event_type", "ts"]).cast("int")
    )
    return tumble(
        checked,
        "ts",
        "1 day",
        [],
        [
            F.sum("accepted").alias("accepted"),
            (F.count(F.lit(1)) - F.sum("accepted")).alias("rejected"),
        ],
    ).drop("window_time", "window_end")


def _high_price(spark, sf) -> DataFrame:
    """The single-signal job: prices above their band."""
    wide = average_signals(
        lines(spark, sf), "l_shipdate", "1 day", "l_suppkey", ["l_extendedprice"], sparse=True
    )
    judged = detect_anomalies(
        wide, ["l_suppkey"], "window_time", "l_extendedprice", LINE_BAND
    ).withColumn("signal", F.lit("l_extendedprice"))
    records = anomaly_records(
        judged, ["l_suppkey", "window_time", "signal"], value="l_extendedprice", sides="high"
    )
    return records.withColumn("is_anomaly", F.lit(True)).drop("direction")


@query
def ctas_engine_anomalies(spark, sf):
    result = anomaly_table(_high_price(spark, sf))
    return rounded(create_table_as(result, shared_dir(spark, "engine_anomalies")))


TYPED_ANOMALIES = schema_of(
    "user_id string, window_time timestamp_ntz, signal string, observed_value double, "
    "expected_value double, upper_bound double, lower_bound double, deviation double, "
    "direction string"
)


@query
def ctas_typed(spark, sf):
    result = anomaly_table(event_anomalies(spark, sf))
    return rounded(
        create_table_as(result, shared_dir(spark, "typed_anomalies"), schema=TYPED_ANOMALIES)
    )


@query
def append_actions(spark, sf):
    """Two appends of the same rows: the key is filled, repeats stay."""
    path = shared_dir(spark, "actions")
    rows = event_series(spark, sf).select(
        F.when(F.col("observed_value") > 2, F.col("user_id").cast("string")).alias("entity"),
        "signal",
        "window_start",
    )
    append_to_table(rows, path, "entity")
    append_to_table(rows, path, "entity")
    return scan(spark, path, rows.schema)


@query
def read_actions(spark, sf):
    done = create_table_as(_actions(spark, sf), shared_dir(spark, "completed_actions"))
    return done.select(
        "l_suppkey",
        "severity",
        "likely_cause",
        "dispatch_summary",
        "dispatch_json",
        "api_response",
    )


@query
def explode_json_list_rows(spark, sf):
    lists = events(spark, sf).select(
        "event_id", F.concat(F.lit('["'), "event_type", F.lit('","u'), "user_id", F.lit('"]'))
        .alias("members"),
    )
    return explode_json_list(lists, "members", "member").select("event_id", "member")


@query
def stage_tables(spark, sf):
    """Each stage reads the table the stage before it wrote."""
    anomalies = create_table_as(
        anomaly_table(signal_anomalies(lines(spark, sf), LINE_WATCH)),
        shared_dir(spark, "anomalies"),
    )
    risks = create_table_as(at_risk(anomalies, LINE_WATCH), shared_dir(spark, "at_risk"))
    done = create_table_as(diagnose(risks, LINE_WATCH), shared_dir(spark, "diagnosed"))
    return rounded(done)


# --- projection, filter, scalars -----------------------------------------------------


@query
def project_alias(spark, sf):
    return events(spark, sf).select(
        F.col("event_id").alias("reading_id"),
        F.col("user_id").alias("entity"),
        F.col("event_type").alias("signal"),
        F.col("value").alias("observed_value"),
    )


@query
def fanout_unpivot(spark, sf):
    return shown(line_series(spark, sf))


@query
def struct_access(spark, sf):
    judged = event_bands(event_series(spark, sf))
    return shown(
        judged.select("user_id", "signal", "window_time", "r.upper_bound", "r.lower_bound")
    )


@query
def filter_anomaly(spark, sf):
    judged = event_bands(event_series(spark, sf)).where(F.col("r.is_anomaly"))
    return shown(judged.select("user_id", "signal", "window_time", "observed_value"))


@query
def high_side_only(spark, sf):
    judged = detect_anomalies(
        line_series(spark, sf), ["l_suppkey", "signal"], "window_time", "observed_value", LINE_BAND
    )
    return shown(
        anomaly_records(judged, ["l_suppkey", "window_time", "signal"], sides="high")
    ).drop("direction")


@query
def low_side_only(spark, sf):
    judged = detect_anomalies(
        line_series(spark, sf), ["l_suppkey", "signal"], "window_time", "observed_value", LINE_BAND
    )
    return shown(
        anomaly_records(judged, ["l_suppkey", "window_time", "signal"], sides="low")
    ).drop("direction")


@query
def direction_label_rows(spark, sf):
    label = direction_label(F.col("value"), F.lit(30.0), F.lit(5.0))
    return events(spark, sf).select("event_id", label.alias("direction"))


@query
def deviation(spark, sf):
    """Observed minus the unrounded forecast, beside the rounded forecast."""
    judged = event_bands(event_series(spark, sf)).where("r.forecast_value is not null")
    return shown(
        judged.select(
            "user_id",
            "signal",
            "window_time",
            (F.col("observed_value") - F.col("r.forecast_value")).alias("deviation"),
        )
    )


@query
def round_values(spark, sf):
    value = F.col("value")
    return events(spark, sf).select(
        "event_id",
        F.round(value, 1).alias("one"),
        F.round(value / 7, 2).alias("two"),
        F.round(value / 7, 3).alias("three"),
    )


@query
def cast_values(spark, sf):
    df = events(spark, sf)
    return df.select(
        "event_id",
        F.col("value").cast("string").alias("value_text"),
        F.col("ts").cast("string").alias("ts_text"),
        F.col("user_id").cast("double").alias("user_double"),
        to_millis(df, "ts").alias("ts_millis"),
    )


@query
def coalesce_text(spark, sf):
    return _gappy(spark, sf).select(
        "event_id", F.coalesce(F.col("value").cast("string"), F.lit("n/a")).alias("value_text")
    )


@query
def concat_null(spark, sf):
    return _gappy(spark, sf).select(
        "event_id", build_prompt([Field("event_type"), ": ", Field("value", 1)]).alias("line")
    )


@query
def trim_text(spark, sf):
    padded = F.concat(F.lit("  "), F.col("text"), F.lit(" \n "))
    return conversations(spark, sf).select("conv_id", "turn", F.trim(padded).alias("trimmed"))


@query
def regex_extract(spark, sf):
    return events(spark, sf).select(
        "event_id", extract_or_null(F.col("props"), r'"k": (9\d)', 1).alias("k_in_nineties")
    )


@query
def ts_minus_interval(spark, sf):
    return events(spark, sf).select("event_id", minus_seconds(F.col("ts"), 5).alias("watermark"))


@query
def json_object(spark, sf):
    return _gappy(spark, sf).select(
        "event_id",
        json_text(
            F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("value")
        ).alias("json"),
    )


# --- windows and aggregation ---------------------------------------------------------


@query
def tumble_1m(spark, sf):
    return shown(
        tumble(
            events(spark, sf),
            "ts",
            "1 minute",
            ["user_id"],
            [F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("reading_count")],
        )
    )


@query
def tumble_5m_of_1m(spark, sf):
    inner = tumble(
        events(spark, sf), "ts", "1 minute", ["event_type"], [F.max("value").alias("top")]
    )
    return shown(
        tumble(
            inner.drop("window_start", "window_end"),
            "window_time",
            "5 minutes",
            ["event_type"],
            [F.max("top").alias("top"), F.count(F.lit(1)).alias("minutes")],
        )
    )


@query
def window_columns(spark, sf):
    return shown(
        tumble(events(spark, sf), "ts", "1 hour", ["user_id"], [F.min("value").alias("least")])
    )


@query
def avg_signals(spark, sf):
    wide = average_signals(
        lines(spark, sf), "l_shipdate", "1 day", "l_suppkey", LINE_SIGNALS, sparse=True
    )
    return shown(wide)


@query
def max_signal(spark, sf):
    top = tumble(events(spark, sf), "ts", "1 hour", ["user_id"], [F.max("value").alias("top")])
    return shown(top)


@query
def reading_count(spark, sf):
    count = [F.count(F.lit(1)).alias("reading_count")]
    return shown(tumble(events(spark, sf), "ts", "1 hour", ["user_id"], count))


def _by_week(spark, sf, *aggregates: Column) -> DataFrame:
    df = events(spark, sf).select(
        "user_id", "ts", F.col("event_type").alias("signal"), F.col("value").alias("observed_value")
    )
    return shown(tumble(df, "ts", "7 days", ["user_id"], aggregates)).drop("window_time")


@query
def distinct_signals_rows(spark, sf):
    return _by_week(spark, sf, distinct_signals(signals=EVENT_SIGNALS).alias("signals_tripped"))


@query
def list_signals_rows(spark, sf):
    return _by_week(spark, sf, list_signals(signals=EVENT_SIGNALS).alias("tripped_signals"))


@query
def signal_pivot_rows(spark, sf):
    return _by_week(spark, sf, *signal_pivot(EVENT_SIGNALS))


@query
def escalate_multi_signal(spark, sf):
    risks = escalate(event_anomalies(spark, sf), "user_id", EVENT_SIGNALS, width="7 days")
    return rounded(risks)


@query
def window_profile_rows(spark, sf):
    return shown(
        window_profile(
            lines(spark, sf),
            "l_shipdate",
            "1 day",
            "l_suppkey",
            "l_extendedprice",
            ["l_quantity"],
            sparse=True,
        )
    )


# --- frames and detection ------------------------------------------------------------


@query
def running_frame_rows(spark, sf):
    frame = running_frame(
        event_series(spark, sf),
        ["user_id", "signal"],
        "window_time",
        {"seen": F.count("observed_value"), "mean_so_far": F.avg("observed_value")},
    )
    return shown(
        frame.select("user_id", "signal", "window_time", "observed_value", "seen", "mean_so_far")
    )


@query
def band_mean(spark, sf):
    return band_rows(event_bands(event_series(spark, sf)))


@query
def band_trend(spark, sf):
    config = BandConfig("trend", min_training=5, max_training=None)
    return band_rows(event_bands(event_series(spark, sf), config))


@query
def band_ar1(spark, sf):
    config = BandConfig("ar1", min_training=5, max_training=None)
    return band_rows(event_bands(event_series(spark, sf), config))


@query
def band_min_training(spark, sf):
    config = BandConfig(min_training=9, max_training=None, confidence=95.0)
    return band_rows(event_bands(event_series(spark, sf), config))


@query
def band_max_training(spark, sf):
    config = BandConfig(min_training=5, max_training=7)
    return band_rows(event_bands(event_series(spark, sf), config))


@query
def band_max_training_trend(spark, sf):
    config = BandConfig("trend", min_training=5, max_training=8, confidence=99.0)
    return band_rows(event_bands(event_series(spark, sf), config))


@query
def band_max_training_ar1(spark, sf):
    config = BandConfig("ar1", min_training=5, max_training=8, confidence=99.0)
    return band_rows(event_bands(event_series(spark, sf), config))


@query
def band_confidence(spark, sf):
    config = BandConfig(min_training=5, max_training=None, confidence=80.0)
    return band_rows(event_bands(event_series(spark, sf), config))


def _global_series(spark, sf) -> DataFrame:
    """Five long series, each with a fifth of all rows."""
    return tumble(
        events(spark, sf).withColumnRenamed("event_type", "signal"),
        "ts",
        "1 minute",
        ["signal"],
        [F.avg("value").alias("observed_value")],
    )


def _split_bands(spark, sf, config: BandConfig) -> DataFrame:
    judged = detect_anomalies(
        _global_series(spark, sf),
        ["signal"],
        "window_time",
        "observed_value",
        config,
        history_span="2 days",
    )
    return band_rows(judged, ("signal",))


@query
def band_split_mean(spark, sf):
    return _split_bands(spark, sf, BandConfig(max_training=None))


@query
def band_split_trend(spark, sf):
    return _split_bands(spark, sf, BandConfig("trend", max_training=None))


@query
def band_split_ar1(spark, sf):
    return _split_bands(spark, sf, BandConfig("ar1", max_training=None))


@query
def band_split_max_training(spark, sf):
    return _split_bands(spark, sf, BandConfig(min_training=50, max_training=120))


@query
def band_dirty(spark, sf):
    """Missing and NaN values train nobody; a row without a time comes before all others."""
    day = F.dayofmonth("window_start")
    rows = event_series(spark, sf).withColumns(
        {
            "observed_value": F.when(day % 5 == 0, None)
            .when(day % 7 == 0, float("nan"))
            .otherwise(F.col("observed_value")),
            "window_time": F.when(day != 12, F.col("window_time")),
        }
    )
    judged = event_bands(rows)
    return shown(judged.select("user_id", "signal", "window_time", "r.*"))


@query
def anomaly_records_rows(spark, sf):
    return rounded(anomaly_table(signal_anomalies(lines(spark, sf), LINE_WATCH)))


@query
def engine_anomalies(spark, sf):
    return rounded(anomaly_table(_high_price(spark, sf)))


@query
def eda_band(spark, sf):
    """Every window with its band at the reference settings: 200, 7000, 99.9."""
    profile = window_profile(
        events(spark, sf).withColumnRenamed("event_type", "signal"),
        "ts",
        "1 minute",
        "signal",
        "value",
    )
    judged = detect_anomalies(
        profile, ["signal"], "window_time", "avg_value", history_span="2 days"
    )
    return shown(
        judged.select(
            "signal", "window_time", "avg_value", "max_value", "reading_count", "r.*"
        )
    )


@query
def at_risk_entities(spark, sf):
    """The flagship: wide telemetry to escalated entities."""
    return rounded(line_risks(spark, sf))


# --- set operations ------------------------------------------------------------------


@query
def union_all(spark, sf):
    df = lines(spark, sf)
    first, *rest = [
        df.select("l_suppkey", F.lit(s).alias("signal"), F.col(s).alias("observed_value"))
        for s in LINE_SIGNALS
    ]
    unnamed = [r.toDF("c1", "c2", "c3") for r in rest]
    return union_branches(first, *unnamed)


# --- inference, parsing, dispatch ----------------------------------------------------


@query
def lateral_apply_rows(spark, sf):
    added = schema_of("signal_upper string, props_length bigint")

    def describe(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "signal_upper": batch["event_type"].str.upper(),
                "props_length": batch["props"].str.len(),
            }
        )

    df = events(spark, sf).select("event_id", "event_type", "props")
    return lateral_apply(df, describe, added, columns=["event_type", "props"])


@query
def build_prompt_rows(spark, sf):
    prompt = diagnosis_prompt("l_suppkey", LINE_LABELS)
    return line_risks(spark, sf).select("l_suppkey", "window_start", prompt.alias("prompt"))


@query
def build_prompt_null(spark, sf):
    """Without a stand-in text one missing sensor makes the whole prompt NULL."""
    prompt = diagnosis_prompt("l_suppkey", LINE_LABELS, null_text=None)
    return line_risks(spark, sf).select("l_suppkey", "window_start", prompt.alias("prompt"))


@query
def ml_predict_rules(spark, sf):
    prompt = diagnosis_prompt("l_suppkey", LINE_LABELS)
    asked = ml_predict(line_risks(spark, sf), RuleModel, prompt)
    return asked.select("l_suppkey", "window_start", "response")


def _diagnosis_answers(spark, sf) -> DataFrame:
    """Answers of all shapes around the conversations' whole texts."""
    kind = F.col("turn") % 5
    severity = (
        F.when(kind == 0, "SEVERITY: CRITICAL\n")
        .when(kind == 1, "severity: high\n")
        .when(kind == 2, "SEVERITY: SEVERE\n")
        .when(kind == 3, "Severity:   LOW\n")
        .otherwise("")
    )
    action = F.when(kind == 4, "").otherwise("\nRECOMMENDED_ACTION: call the ")
    who = F.when(kind == 4, "").otherwise(F.col("role"))
    return conversations(spark, sf).select(
        "conv_id",
        "turn",
        F.concat(severity, F.lit("LIKELY_CAUSE: "), "text", action, who).alias("response"),
    )


@query
def parse_diagnosis(spark, sf):
    return parse_sections(_diagnosis_answers(spark, sf), "response", DIAGNOSIS_SECTIONS).drop(
        "response"
    )


@query
def agent_input_rows(spark, sf):
    diagnosed = diagnose(line_risks(spark, sf), LINE_WATCH)
    return diagnosed.select(
        "l_suppkey",
        "window_start",
        agent_input("l_suppkey", LINE_SIGNALS).alias("strict"),
        agent_input("l_suppkey", LINE_SIGNALS, null_text="n/a").alias("filled"),
    )


@query
def invocation_key_rows(spark, sf):
    return line_risks(spark, sf).select(
        "l_suppkey", "window_start", invocation_key("l_suppkey").alias("key")
    )


def _causes(spark, sf) -> DataFrame:
    """Events read as diagnoses: a severity and a cause that names none to three sensors."""
    pick = F.col("event_id") % 5
    severity = (
        F.when(pick == 0, "CRITICAL")
        .when(pick == 1, "high")
        .when(pick == 2, "MEDIUM")
        .when(pick == 3, "LOW")
        .otherwise("UNKNOWN")
    )
    cause = F.concat(
        F.lit("drift"),
        F.when(F.col("value") > 10, " of Vibration").otherwise(""),
        F.when(F.col("user_id") % 2 == 0, " with engine_temp").otherwise(""),
        F.when(F.col("event_type") == "error", " and oil_pressure").otherwise(""),
    )
    return events(spark, sf).select(
        "event_id", "user_id", severity.alias("severity"), cause.alias("likely_cause")
    )


@query
def dispatch_policy_rows(spark, sf):
    policy = dispatch_policy(_causes(spark, sf))
    return policy.withColumn("max_eta_miles", F.col("max_eta_miles").cast("string"))


@query
def parts_lookup(spark, sf):
    parts = parts_for(F.col("likely_cause"))
    return _causes(spark, sf).select("event_id", F.to_json(parts).alias("parts"))


def _centers(spark, sf) -> DataFrame:
    """Line items as offers: supplier (entity), part (shop), quantity (miles), specialty."""
    return lines(spark, sf).select(
        F.col("l_suppkey").alias("user_id"),
        F.concat(F.lit("SHOP-"), F.col("l_partkey").cast("string")).alias("shop_id"),
        F.col("l_quantity").alias("miles"),
        F.when(F.col("l_tax") > 0.06, "vibration")
        .when(F.col("l_tax") > 0.03, "engine_temp")
        .otherwise("oil_pressure")
        .alias("specialty"),
    )


def _with_shops(spark, sf) -> DataFrame:
    return shop_lookup(
        dispatch_policy(_causes(spark, sf)), _centers(spark, sf), "user_id", specialty="specialty"
    )


@query
def shop_lookup_rows(spark, sf):
    return _with_shops(spark, sf).select(
        "event_id", "status", "shop_id", F.col("eta_miles").cast("string").alias("eta_miles")
    )


@query
def dispatch_json_rows(spark, sf):
    orders = _with_shops(spark, sf).withColumn(
        "parts_to_pre_stage", parts_for(F.col("likely_cause"))
    )
    return orders.select("event_id", dispatch_json("user_id").alias("dispatch_json"))


def _action_reports(spark, sf) -> DataFrame:
    """Reports of all shapes around the conversations' whole texts."""
    kind = F.col("turn") % 4
    mark = F.when(kind == 1, "**").otherwise("")
    gap = F.when(kind == 3, "\n").otherwise("\n\n")
    body = F.concat(F.lit('{"status": "'), F.col("role"), F.lit('"}'))
    fenced = F.when(kind == 2, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    heading = lambda text: F.concat(mark, F.lit(text), mark, F.lit("\n"))
    return conversations(spark, sf).select(
        "conv_id",
        "turn",
        F.concat(
            heading("Dispatch Summary:"),
            F.col("text"),
            gap,
            heading("Dispatch JSON:"),
            fenced,
            F.lit("\n\n"),
            heading("API Response:"),
            F.lit("200 OK for "),
            F.col("role"),
        ).alias("response"),
    )


@query
def parse_actions(spark, sf):
    parsed = parse_sections(_action_reports(spark, sf), "response", ACTION_SECTIONS)
    status = F.from_json("dispatch_json", schema_of("status string"))["status"]
    return parsed.select("conv_id", "turn", *ACTION_SECTIONS, status.alias("status"))


@query
def diagnose_stage(spark, sf):
    return rounded(diagnose(line_risks(spark, sf), LINE_WATCH))


def _actions(spark, sf) -> DataFrame:
    diagnosed = create_table_as(
        diagnose(line_risks(spark, sf), LINE_WATCH), shared_dir(spark, "diagnosed")
    )
    return act(diagnosed, LINE_WATCH)


@query
def run_agent_rules(spark, sf):
    return _actions(spark, sf).select("l_suppkey", "window_start", "raw_response")


@query
def action_stage(spark, sf):
    return _actions(spark, sf)


def _tool_diagnoses(spark, sf) -> DataFrame:
    """Diagnoses whose cause names one of two specialties, or none, stored."""
    word = (
        F.when(F.col("l_suppkey") % 3 == 0, " (vibration)")
        .when(F.col("l_suppkey") % 3 == 1, " (engine_temp)")
        .otherwise("")
    )
    diagnosed = diagnose(line_risks(spark, sf), LINE_WATCH)
    named = diagnosed.withColumn("likely_cause", F.concat("likely_cause", word))
    return create_table_as(named, shared_dir(spark, "diagnosed"))


def _far_centers(spark, sf) -> DataFrame:
    """Line items as offers, those of every fourth supplier beyond the shortest limit."""
    far = F.when(F.col("l_suppkey") % 4 == 3, 60.0).otherwise(0.0)
    centers = _centers(spark, sf).withColumnRenamed("user_id", "l_suppkey")
    return centers.withColumn("miles", F.col("miles") * 3 + far)


class PostRefused(OSError):
    code = 403


def post_order(arguments: dict, key: str, timeout: float) -> str:
    """An endpoint that is down for some vehicles and refuses the orders of others."""
    vehicle = int(arguments["body"]["truck_id"])
    if vehicle % 5 == 0:
        raise ConnectionError("no route")
    if vehicle % 5 == 1:
        raise PostRefused("order refused")
    return f"201 for {key}"


@query
def action_stage_tools(spark, sf):
    """The agent with tools: shops from a table, orders taken, refused or not deliverable."""
    return act(
        _tool_diagnoses(spark, sf),
        LINE_WATCH,
        dispatch_agent(http_post=post_order),
        concurrency=4,
        offers=offer_lists(_far_centers(spark, sf), "l_suppkey"),
    )


@query
def agent_ledger(spark, sf):
    """Two deliveries that overlap: the second calls the agent for new invocations only."""
    diagnosed = create_table_as(
        diagnose(line_risks(spark, sf), LINE_WATCH), shared_dir(spark, "diagnosed")
    )
    path = shared_dir(spark, "ledger")
    deliveries = [diagnosed.where(F.col("l_suppkey") % 3 != 0), diagnosed]
    for number, rows in enumerate(deliveries):
        act(rows, LINE_WATCH, ledger=Ledger(spark, path, number))
    return Ledger(spark, path).rows()


# --- streams -------------------------------------------------------------------------


def _plain(df: DataFrame) -> DataFrame:
    """Times without a zone, as the tables have them."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def _stored(
    spark: SparkSession, df: DataFrame, label: str, end: EndOfInput | None = None
) -> DataFrame:
    """Run a stream over what is there and read its result; times come out zone-less."""
    out, checkpoint = shared_dir(spark, label), shared_dir(spark, f"{label}-checkpoint")
    return run_to_end(_plain(df), out, checkpoint, end, at_once=True)


def _event_end(spark: SparkSession) -> EndOfInput:
    return EndOfInput(spark, shared_dir(spark, "events-end"), EVENTS, "ts")


def _line_end(spark: SparkSession) -> EndOfInput:
    return EndOfInput(spark, shared_dir(spark, "lines-end"), LINEITEM, "l_shipdate")


def _event_stream(spark: SparkSession, sf: str, end: EndOfInput | None = None) -> DataFrame:
    """Events as a stream; the glob lets a table be one file or a folder of files."""
    stream = scan_stream(spark, f"{sf}/events.parquet*", EVENTS, "ts", end=end)
    return stream.withColumnRenamed("event_type", "signal")


def _line_stream(spark: SparkSession, sf: str, end: EndOfInput | None = None) -> DataFrame:
    return scan_stream(spark, f"{sf}/lineitem.parquet*", LINEITEM, "l_shipdate", end=end)


def _day_series(readings: DataFrame) -> DataFrame:
    return tumble(
        readings, "ts", "1 day", ["user_id", "signal"], [F.avg("value").alias("observed_value")]
    )


@query
def stream_tumble(spark, sf):
    """Windows of a stream, each emitted once; the end of the input closes the last."""
    with stream_session(spark, replay=events(spark, sf)):
        end = _event_end(spark)
        windows = tumble(
            _event_stream(spark, sf, end),
            "ts",
            "1 minute",
            ["signal"],
            [F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("reading_count")],
        )
        return rounded(_stored(spark, shown(windows), "stream_tumble", end))


@query
def stream_band_rows(spark, sf):
    with stream_session(spark, replay=events(spark, sf)):
        end = _event_end(spark)
        judged = stream_band(
            _day_series(_event_stream(spark, sf, end)),
            ["user_id", "signal"],
            "window_time",
            "observed_value",
            EVENT_BAND,
        )
        return _stored(spark, band_rows(judged), "stream_band", end)


@query
def stream_escalate(spark, sf):
    """One chained job from wide telemetry to escalated entities."""
    with stream_session(spark, replay=lines(spark, sf)):
        end = _line_end(spark)
        anomalies = signal_anomalies(_line_stream(spark, sf, end), LINE_WATCH)
        return _stored(spark, rounded(at_risk(anomalies, LINE_WATCH)), "stream_escalate", end)


@query
def stream_diagnose(spark, sf):
    """The same job with the diagnosis behind it."""
    with stream_session(spark, replay=lines(spark, sf)):
        end = _line_end(spark)
        anomalies = signal_anomalies(_line_stream(spark, sf, end), LINE_WATCH)
        diagnosed = diagnose(at_risk(anomalies, LINE_WATCH), LINE_WATCH)
        return _stored(spark, rounded(diagnosed), "stream_diagnose", end)


@query
def stream_actions(spark, sf):
    """Escalations as they close, diagnosed and then acted on from the stored diagnosis."""
    done = shared_dir(spark, "stream_actions")
    steps = [
        (shared_dir(spark, "stream_diagnosed"), lambda risks: diagnose(risks, LINE_WATCH)),
        (done, lambda diagnosed: act(diagnosed, LINE_WATCH)),
    ]
    with stream_session(spark, replay=lines(spark, sf)):
        end = _line_end(spark)
        risks = at_risk(signal_anomalies(_line_stream(spark, sf, end), LINE_WATCH), LINE_WATCH)
        checkpoint = shared_dir(spark, "stream_actions-checkpoint")
        drain(lambda: start_written_steps(_plain(risks), steps, checkpoint), end, at_once=True)
        # The folders of the batches show as one more column.
        return scan(spark, done, ACTIONS).select(*ACTIONS.fieldNames())


#: Up to here the history is stored, from here on it is live.
LIVE_FROM = "2024-01-16"
#: A user's series starts anew after so long a silence.
RETIRE = "3 days"
EVENT_KEYS = ["user_id", "signal"]


def seeded_band(spark: SparkSession, sf: str, cut: str, config: BandConfig) -> DataFrame:
    """Bands of the history by the batch operator, and of the rest by a stream it seeds."""
    with stream_session(spark, replay=events(spark, sf)):
        end = _event_end(spark)
        readings = events(spark, sf).withColumnRenamed("event_type", "signal")
        past = _day_series(readings.where(F.col("ts") < F.lit(cut).cast("timestamp_ntz")))
        series = ("window_time", "observed_value", config)
        seed = create_table_as(
            band_seed(past, EVENT_KEYS, *series), shared_dir(spark, "band_seed")
        )
        live = _event_stream(spark, sf, end).where(F.col("ts") >= F.lit(cut).cast("timestamp"))
        judged = stream_band(_day_series(live), EVENT_KEYS, *series, seed=seed)
        after = _stored(spark, band_rows(judged), "stream_band_seeded", end)
        return band_rows(event_bands(past, config)).unionByName(after)


@query
def stream_band_seeded(spark, sf):
    return seeded_band(spark, sf, LIVE_FROM, EVENT_BAND)


@query
def stream_band_retired(spark, sf):
    """A series forgets its history after a long silence, and its state goes."""
    with stream_session(spark, replay=events(spark, sf)):
        end = _event_end(spark)
        judged = stream_band(
            _day_series(_event_stream(spark, sf, end)),
            EVENT_KEYS,
            "window_time",
            "observed_value",
            EVENT_BAND,
            retire=RETIRE,
        )
        return _stored(spark, band_rows(judged), "stream_band_retired", end)


@query
def stream_rejects(spark, sf):
    """Rows of a stream that break the contract, kept beside the rows that do not."""
    stream = scan_stream(spark, f"{sf}/events.parquet*", EVENTS)
    gappy = _gappy_columns(stream)
    accepted, rejected, checkpoint = (
        shared_dir(spark, f"stream_{name}") for name in ("accepted", "rejects", "split")
    )
    drain(lambda: start_split(gappy, GAPPY_COLUMNS, accepted, rejected, checkpoint))
    return scan_batches(spark, rejected, gappy.schema)


def _arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Events in four slices of eight days; one in ten comes a slice later."""
    day = F.dayofmonth("ts") - 1
    slice_ = F.floor(day / 8) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    return events(spark, sf).withColumn("slice", F.least(slice_, F.lit(3)))


@query
def stream_late_rows_rows(spark, sf):
    """Rows that came after their hour had closed, with the watermark they met."""
    with stream_session(spark):
        arrivals = _arrivals(spark, sf)
        source, accepted, late, marks, checkpoint = (
            shared_dir(spark, f"late_{name}")
            for name in ("source", "accepted", "rows", "marks", "checkpoint")
        )
        for number in range(4):  # each slice is one micro-batch
            part = arrivals.where(F.col("slice") == number).drop("slice")
            part.write.mode("append").parquet(source)
            stream = scan_stream(spark, source, EVENTS)
            start_late_split(
                stream, "ts", "1 hour", "5 seconds", accepted, late, marks, checkpoint
            ).awaitTermination()
        found = scan_batches(spark, late, schema_of(f"{EVENTS_TEXT}, watermark timestamp"))
        return found.select(
            "event_id", "ts", "user_id", F.col("watermark").cast("timestamp_ntz").alias("watermark")
        )


def line_stages() -> list[Stage]:
    """Windows, anomalies, escalations and diagnoses, each a job with a table of its own."""
    return [
        Stage("windows", lambda df: windowed_signals(df, LINE_WATCH), "l_shipdate"),
        Stage(
            "anomalies",
            lambda df: anomaly_table(window_anomalies(df, LINE_WATCH)),
            "window_time",
        ),
        Stage("at_risk", lambda df: at_risk(df, LINE_WATCH), "window_time"),
        Stage("diagnosed", lambda df: diagnose(df, LINE_WATCH)),
    ]


@query
def stream_stage_tables(spark, sf):
    """Four jobs, each streaming the table that the one before writes."""
    with stream_session(spark, replay=lines(spark, sf)):
        jobs = StagedTables(
            lambda end: _line_stream(spark, sf, end),
            shared_dir(spark, "stream_stages"),
            line_stages(),
            _line_end(spark),
        )
        jobs.close()
        return rounded(_plain(jobs.table("diagnosed", spark)))
