"""The stages from telemetry to completed actions, for batch and for streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalguard.functions.text import (
    ACTION_SECTIONS,
    DIAGNOSIS_SECTIONS,
    NOT_AVAILABLE,
    SENSOR_LABELS,
    agent_input,
    diagnosis_prompt,
    invocation_key,
    parse_sections,
)
from signalguard.operators.detect import (
    BandConfig,
    anomaly_records,
    detect_signals,
    unpivot_signals,
)
from signalguard.operators.dispatch import dispatch_agent
from signalguard.operators.enrich import AgentSpec, Model, RuleModel, ml_predict, run_agent
from signalguard.operators.escalate import escalate
from signalguard.operators.ledger import Ledger
from signalguard.operators.windows import average_signals, public_window_time
from signalguard.streaming.band import stream_band


@dataclass(frozen=True)
class Watch:
    """What is watched and how; the defaults are those of a truck fleet.

    ``sparse`` is explained at ``tumble``; streams, whose state has its own tasks, ignore it.
    """

    entity: str = "truck_id"
    ts: str = "reading_ts"
    labels: Mapping[str, tuple[str, int, str]] = field(default_factory=lambda: SENSOR_LABELS)
    width: str = "1 minute"
    band: BandConfig = BandConfig()
    sides: str = "both"
    rollup: str = "5 minutes"
    min_signals: int = 2
    null_text: str | None = NOT_AVAILABLE
    history_span: str | None = None
    sparse: bool = False

    @property
    def signals(self) -> list[str]:
        return list(self.labels)


def windowed_signals(telemetry: DataFrame, watch: Watch) -> DataFrame:
    """Readings to one wide row per entity and window."""
    sparse = watch.sparse and not telemetry.isStreaming
    return average_signals(telemetry, watch.ts, watch.width, watch.entity, watch.signals, sparse)


def signal_series(telemetry: DataFrame, watch: Watch) -> DataFrame:
    """Readings to one windowed series per entity and signal."""
    wide = windowed_signals(telemetry, watch)
    return unpivot_signals(wide, [watch.entity, "window_time"], watch.signals)


def signal_anomalies(telemetry: DataFrame, watch: Watch) -> DataFrame:
    """Anomaly records of all signals; works on a batch and on a watermarked stream."""
    return window_anomalies(windowed_signals(telemetry, watch), watch)


def window_anomalies(windows: DataFrame, watch: Watch) -> DataFrame:
    """The same from the rows of ``windowed_signals``, say of a stored table of them."""
    if windows.isStreaming and watch.history_span is not None:
        raise ValueError("history_span splits stored series; a stream keeps its own state")
    if windows.isStreaming:
        judged = stream_band(
            windows,
            [watch.entity],
            "window_time",
            watch.signals,
            watch.band,
            only_anomalies=True,
        )
    else:
        judged = detect_signals(
            windows,
            [watch.entity],
            "window_time",
            watch.signals,
            watch.band,
            only_anomalies=True,
            history_span=watch.history_span,
        )
    return anomaly_records(judged, [watch.entity, "window_time", "signal"], sides=watch.sides)


def anomaly_table(anomalies: DataFrame) -> DataFrame:
    """Anomaly records as stored: window time at millisecond precision."""
    return anomalies.withColumn("window_time", public_window_time())


def at_risk(anomalies: DataFrame, watch: Watch) -> DataFrame:
    """Entities on which several signals tripped in one roll-up window."""
    return escalate(
        anomalies, watch.entity, watch.signals, width=watch.rollup, min_signals=watch.min_signals
    )


def diagnose(
    risks: DataFrame,
    watch: Watch,
    model_factory: Callable[[], Model] = RuleModel,
    tasks: int | None = None,
) -> DataFrame:
    """Ask a model about each escalated row and parse its answer."""
    prompt = diagnosis_prompt(watch.entity, watch.labels, watch.null_text)
    asked = ml_predict(risks, model_factory, prompt, out="raw_diagnosis", tasks=tasks)
    parsed = parse_sections(asked, "raw_diagnosis", DIAGNOSIS_SECTIONS)
    return parsed.select(*risks.columns, *DIAGNOSIS_SECTIONS, "raw_diagnosis")


def act(
    diagnosed: DataFrame,
    watch: Watch,
    agent: AgentSpec | None = None,
    concurrency: int = 1,
    tasks: int | None = None,
    offers: DataFrame | None = None,
    ledger: Ledger | None = None,
) -> DataFrame:
    """Run the dispatch agent on each diagnosis and parse its report.

    ``offers``, from ``offer_lists``, has what looking shops up returns for an entity; an
    entity without a row has no shops.  Agents may have side effects: read ``diagnosed``
    from a written table, and give a ``ledger``, which keeps finished invocations from being
    made again.
    """
    given = diagnosed.columns
    replies = None
    if offers is not None:
        diagnosed = diagnosed.join(offers, watch.entity, "left")
        replies = {"http_get": F.coalesce(F.col("offers"), F.lit("[]"))}

    def call(rows: DataFrame) -> DataFrame:
        return run_agent(
            rows,
            agent or dispatch_agent(),
            agent_input(watch.entity, watch.signals, watch.null_text),
            invocation_key(watch.entity),
            out="raw_response",
            concurrency=concurrency,
            tasks=tasks,
            replies=replies,
        )

    if ledger is None:
        asked = call(diagnosed)
    else:
        asked = ledger.call(diagnosed, invocation_key(watch.entity), call, "raw_response")
    parsed = parse_sections(asked.select(*given, "raw_response"), "raw_response", ACTION_SECTIONS)
    return parsed.select(
        F.coalesce(F.col(watch.entity).cast("string"), F.lit("UNKNOWN")).alias(watch.entity),
        "window_start",
        *DIAGNOSIS_SECTIONS,
        *ACTION_SECTIONS,
        "raw_response",
    )
