"""Text in and out of a model: prompts from rows, columns from answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalguard.functions.scalar import extract_or_null, round_half_up

# Patterns of the answer formats, one capturing group each.
DIAGNOSIS_SECTIONS = {
    "severity": r"(?i)SEVERITY:\s*(CRITICAL|HIGH|MEDIUM|LOW)",
    "likely_cause": r"(?i)LIKELY_CAUSE:\s*([\s\S]+?)(?=\n\s*(?:RECOMMENDED_ACTION|$))",
    "recommended_action": r"(?i)RECOMMENDED_ACTION:\s*([\s\S]+?)$",
}
ACTION_SECTIONS = {
    "dispatch_summary": (
        r"\*{0,2}Dispatch Summary:\*{0,2}\s*\n([\s\S]+?)(?=\n\n\*{0,2}Dispatch JSON:\*{0,2})"
    ),
    "dispatch_json": (
        r"\*{0,2}Dispatch JSON:\*{0,2}\s*\n(?:```json\s*)?([\s\S]+?)(?:```)?"
        r"(?=\n\n\*{0,2}API Response:\*{0,2})"
    ),
    "api_response": r"\*{0,2}API Response:\*{0,2}\s*\n(?:```json\s*)?([\s\S]+?)(?:```)?$",
}
# Label, decimals and healthy level of each sensor in a prompt.
SENSOR_LABELS = {
    "engine_temp_c": ("Engine temperature (C)", 1, "88"),
    "oil_pressure_psi": ("Oil pressure (psi)", 1, "52"),
    "vibration_g": ("Vibration (g)", 3, "0.32"),
    "tire_psi_avg": ("Tire pressure (psi)", 1, "102"),
    "fuel_efficiency_mpg": ("Fuel efficiency (mpg)", 2, "7.2"),
}
NOT_AVAILABLE = "n/a"


@dataclass(frozen=True)
class Field:
    """A column in a text: rounded, cast to string, with a text in place of NULL."""

    column: str
    decimals: int | None = None
    null_text: str | None = None

    def text(self) -> Column:
        c = F.col(self.column)
        if self.decimals is not None:
            c = round_half_up(c, self.decimals)
        c = c.cast("string")
        return c if self.null_text is None else F.coalesce(c, F.lit(self.null_text))


def build_prompt(parts: Sequence[str | Field]) -> Column:
    """Concatenate literal text and fields; NULL if a field is NULL and has no null_text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.text() for p in parts])


def sensor_lines(
    labels: Mapping[str, tuple[str, int, str]], null_text: str | None = NOT_AVAILABLE
) -> list[str | Field]:
    """One line per sensor: label, rounded reading, healthy level."""
    parts: list[str | Field] = []
    for column, (label, decimals, healthy) in labels.items():
        parts += [f"{label}: ", Field(column, decimals, null_text), f" (normal near {healthy})\n"]
    return parts


def diagnosis_prompt(
    entity: str,
    labels: Mapping[str, tuple[str, int, str]] = SENSOR_LABELS,
    null_text: str | None = NOT_AVAILABLE,
) -> Column:
    """Prompt of an escalated row, asking for the three labelled lines."""
    return build_prompt(
        [
            "Several sensors of one vehicle left their forecast band together. Name the most "
            "probable fault. Answer with these three lines and nothing else:\n"
            "SEVERITY: one of CRITICAL, HIGH, MEDIUM, LOW\n"
            "LIKELY_CAUSE: the fault in one sentence\n"
            "RECOMMENDED_ACTION: what to do, in one sentence\n\n"
            "Vehicle: ",
            Field(entity),
            "\nOutside the band: ",
            Field("tripped_signals"),
            " (",
            Field("signals_tripped"),
            " distinct signals)\n",
            *sensor_lines(labels, null_text),
            "\nUse CRITICAL only where a breakdown within about 50 miles must be feared.",
        ]
    )


def agent_input(
    entity: str,
    sensors: Sequence[str],
    null_text: str | None = None,
    entity_label: str = "truck_id",
) -> Column:
    """``name: value`` list for the dispatch agent.

    With ``null_text=None`` the whole text is NULL when a sensor is; severity, cause
    and action always have a stand-in.
    """
    fields = [
        (entity_label, Field(entity)),
        ("severity", Field("severity", null_text="UNKNOWN")),
        ("likely_cause", Field("likely_cause", null_text="")),
        ("recommended_action", Field("recommended_action", null_text="")),
        *[(s, Field(s, null_text=null_text)) for s in sensors],
    ]
    parts: list[str | Field] = []
    for place, (label, field) in enumerate(fields):
        parts += [f"{', ' if place else ''}{label}: ", field]
    return build_prompt(parts)


def invocation_key(entity: str, window_start: str = "window_start") -> Column:
    """Names one agent call; tools with side effects use it to drop repeats."""
    return F.concat(F.col(entity).cast("string"), F.lit("_"), F.col(window_start).cast("string"))


def parse_sections(
    df: DataFrame, column: str, sections: Mapping[str, str] = DIAGNOSIS_SECTIONS
) -> DataFrame:
    """One column per section: the pattern's first group, without outer blanks, or NULL."""
    text = F.col(column).cast("string")
    return df.withColumns(
        {name: F.trim(extract_or_null(text, pattern)) for name, pattern in sections.items()}
    )
