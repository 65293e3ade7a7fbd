"""Declared schemas of the source table and of every result table."""

from __future__ import annotations

from pyspark.sql import types as T

# Table layouts and signal names that results are compared on.
SENSOR_SIGNALS = (
    "engine_temp_c",
    "oil_pressure_psi",
    "vibration_g",
    "tire_psi_avg",
    "brake_pad_mm",
    "fuel_efficiency_mpg",
)
# The signals monitored by default: every sensor but the brake pads.
DEFAULT_SIGNALS = tuple(s for s in SENSOR_SIGNALS if s != "brake_pad_mm")

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def schema_of(spec: str, nullable: bool = True) -> T.StructType:
    """``"a string, b double"`` as a StructType; usable before a session exists."""
    pairs = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], nullable) for name, kind in pairs])


def _doubles(names) -> str:
    return ", ".join(f"{n} double" for n in names)


TELEMETRY = schema_of(
    f"reading_id string, truck_id string, {_doubles(SENSOR_SIGNALS)}, rpm int, "
    "speed_mph double, ambient_temp_c double, reading_ts timestamp",
    nullable=False,
)
TRUCK_ANOMALIES = schema_of(
    "truck_id string, window_time timestamp, signal string, observed_value double, "
    "expected_value double, upper_bound double, lower_bound double, deviation double, "
    "direction string"
)
AT_RISK = schema_of(
    "truck_id string, window_start timestamp, window_end timestamp, signals_tripped bigint, "
    f"tripped_signals string, {_doubles(DEFAULT_SIGNALS)}"
)
DIAGNOSED = T.StructType(
    AT_RISK.fields
    + schema_of(
        "severity string, likely_cause string, recommended_action string, raw_diagnosis string"
    ).fields
)
COMPLETED_ACTIONS = schema_of(
    "truck_id string, window_start timestamp, severity string, likely_cause string, "
    "recommended_action string, dispatch_summary string, dispatch_json string, "
    "api_response string, raw_response string"
)
DISPATCH = T.StructType(
    schema_of(
        "action string, truck_id string, severity string, status string, shop_id string, "
        "eta_miles int"
    ).fields
    + [
        T.StructField("parts_to_pre_stage", T.ArrayType(T.StringType())),
        T.StructField("diagnosis", T.StringType()),
    ]
)
TELEMETRY_AVRO_NAME = "truck_telemetry_value"
