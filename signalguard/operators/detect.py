"""Forecast bands per series, from history only.

A series is one entity and signal, with at most one row per time after ``tumble``.
Three closed-form models forecast the current value from earlier rows:

* ``mean``:  the mean of earlier values;
* ``trend``: a least-squares line of value on time;
* ``ar1``:   a least-squares line of value on the value before it.

The band is ``forecast +- z * s`` with the sample deviation of the residuals.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalguard.functions.moments import (
    Moments,
    aggregate,
    merge,
    read_moments,
    running_total,
    state_columns,
)
from signalguard.functions.scalar import direction_label, hours_since, round_half_up
from signalguard.session import dealt, shared_dir
from signalguard.sources.tables import create_table_as

MODELS = ("mean", "trend", "ar1")

# Accepted spellings of the detector's options.
OPTION_NAMES = {
    "minTrainingSize": "min_training",
    "min_training_size": "min_training",
    "maxTrainingSize": "max_training",
    "max_training_size": "max_training",
    "confidencePercentage": "confidence",
    "confidence_percentage": "confidence",
    "enableStl": "enable_stl",
    "enable_stl": "enable_stl",
}


BAND_FIELDS = ("forecast_value", "upper_bound", "lower_bound", "is_anomaly", "training_size")


@dataclass(frozen=True)
class BandConfig:
    """Detector settings; ``max_training=None`` trains on the whole history."""

    model: str = "mean"
    min_training: int = 200
    max_training: int | None = 7000
    confidence: float = 99.9
    enable_stl: bool = False
    time_origin: str = "2024-01-01 00:00:00"

    def __post_init__(self):
        if self.model not in MODELS:
            raise ValueError(f"unknown model {self.model!r}; use one of {MODELS}")
        least = 2 if self.model == "mean" else 3
        if self.min_training < least:
            raise ValueError(f"{self.model} needs min_training >= {least}")
        if self.max_training is not None and self.max_training < self.min_training:
            raise ValueError("max_training is below min_training")
        if not 0 < self.confidence < 100:
            raise ValueError("confidence is a percentage between 0 and 100")
        if self.enable_stl:
            raise NotImplementedError("seasonal decomposition is not available")

    @classmethod
    def from_options(cls, options: dict, **rest) -> BandConfig:
        """Build from a JSON-style option map; an unknown key is an error."""
        unknown = sorted(set(options) - set(OPTION_NAMES))
        if unknown:
            raise ValueError(f"unknown detector options: {', '.join(unknown)}")
        return cls(**{OPTION_NAMES[k]: v for k, v in options.items()}, **rest)

    @property
    def z(self) -> float:
        return NormalDist().inv_cdf(0.5 + self.confidence / 200.0)

    @property
    def paired(self) -> bool:
        return self.model != "mean"


def unpivot_signals(
    df: DataFrame, ids: Sequence[str], signals: Sequence[str], value: str = "observed_value"
) -> DataFrame:
    """One row per signal instead of one column per signal, in a single scan."""
    return df.unpivot(list(ids), list(signals), "signal", value)


def detect_anomalies(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    value: str,
    config: BandConfig = BandConfig(),
    out: str = "r",
    history_span: str | None = None,
) -> DataFrame:
    """Add a struct ``out``: forecast_value, upper_bound, lower_bound, is_anomaly, training_size.

    One row out per row in.  By default a series is one window partition, which suits
    rows that went through ``tumble``: a series then has at most one row per window,
    however hot its entity is.  For series without such a bound give ``history_span``
    (say ``"7 days"``): a series is then cut into time chunks that are summed on many
    tasks, and the sums before each chunk are added to its rows; the rows are written to the
    shared folder for that.  Both ways agree up to floating-point rounding.
    """
    judged = _judge(df, list(series), ts, {"_r0": value}, config, history_span)
    # One-row generation keeps later filters on the result from being pushed below the
    # arithmetic, which would then run once for the filter and again for the columns.
    band = F.struct(*[F.col(f"_r0.{f}").alias(f"_{f}") for f in BAND_FIELDS])
    rows = judged.select(*df.columns, F.inline(F.array(band)))
    return rows.select(
        *df.columns, F.struct(*[F.col(f"_{f}").alias(f) for f in BAND_FIELDS]).alias(out)
    )


def detect_signals(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    signals: Sequence[str],
    config: BandConfig = BandConfig(),
    only_anomalies: bool = False,
    history_span: str | None = None,
) -> DataFrame:
    """``detect_anomalies`` for every signal of wide rows: keys, ts, signal, observed_value, r.

    Same rows as unpivoting first, but the wide rows are exchanged and sorted once for all
    signals.  The paired models need six aggregates per signal and frame, too many for one
    window operator to run compiled, so their signals do become rows first.
    """
    if config.paired:
        long = unpivot_signals(df, [*keys, ts], signals)
        rows = detect_anomalies(
            long, [*keys, "signal"], ts, "observed_value", config, history_span=history_span
        )
        return rows.where("r.is_anomaly") if only_anomalies else rows
    bands = {f"_r{i}": s for i, s in enumerate(signals)}
    judged = _judge(df.select(*keys, ts, *signals), list(keys), ts, bands, config, history_span)
    cells = [
        F.struct(
            F.lit(s).alias("signal"),
            F.col(s).cast("double").alias("observed_value"),
            *[F.col(f"{band}.{f}").alias(f) for f in BAND_FIELDS],
        )
        for band, s in bands.items()
    ]
    rows = judged.select(*keys, ts, F.inline(F.array(*cells)))
    if only_anomalies:
        rows = rows.where("is_anomaly")
    return rows.select(*keys, ts, "signal", "observed_value", F.struct(*BAND_FIELDS).alias("r"))


@dataclass(frozen=True)
class _Slot:
    """One signal: its value column and the names of its working columns."""

    place: int
    value: str
    model: str

    @property
    def y(self) -> Column:
        """NaN is a missing reading: Spark sorts it above every number, so it would trip."""
        return F.nanvl(F.col(self.value).cast("double"), F.lit(None).cast("double"))

    @property
    def x(self) -> str | None:
        return {"mean": None, "trend": "_x", "ar1": f"_x{self.place}"}[self.model]

    def named(self, part: str) -> str:
        return f"_{part}{self.place}"

    def moments(self, part: str, over=None, only: Column | None = None) -> dict[str, Column]:
        y = self.y if only is None else F.when(only, self.y)
        x = F.col(self.x) if self.x else None
        return aggregate(y, x, over).columns(self.named(part))


def _all(parts: Iterable[dict[str, Column]]) -> dict[str, Column]:
    return {name: column for part in parts for name, column in part.items()}


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _judge(
    df: DataFrame,
    keys: list[str],
    ts: str,
    bands: dict[str, str],
    config: BandConfig,
    span: str | None,
) -> DataFrame:
    """Add one band struct per value column; ``bands`` maps the struct's name to the value."""
    slots = [_Slot(i, value, config.model) for i, value in enumerate(bands.values())]
    work = df
    if config.model == "trend":
        work = work.withColumn("_x", hours_since(df, ts, config.time_origin))
    if span is None:
        work = _one_partition_per_key(work, keys, ts, slots, config)
    else:
        work = _chunked(work, keys, ts, slots, config, span)
    work = work.withColumns(
        _all(_state(work, s, config).columns(s.named("state")) for s in slots)
    )
    return work.select(
        *df.columns,
        *[_band(s, config).alias(name) for s, name in zip(slots, bands, strict=True)],
    )


def _state(df: DataFrame, slot: _Slot, config: BandConfig) -> Moments:
    """History before each row: what the row's piece holds, plus what was carried in."""
    here = read_moments(slot.named("prefix"), config.paired)
    if f"{slot.named('carry')}_n" not in df.columns:
        return here
    return merge(read_moments(slot.named("carry"), config.paired), here)


def _one_partition_per_key(
    df: DataFrame, keys: list[str], ts: str, slots: list[_Slot], config: BandConfig
) -> DataFrame:
    """All windows hash on the keys, so one exchange serves them all; it makes small tasks."""
    if keys:
        df = dealt(df, *keys)
    whole = Window.partitionBy(*keys).orderBy(ts)
    if config.model == "ar1":
        df = df.withColumns({s.x: F.lag(s.y).over(whole) for s in slots})
    if config.max_training is None:
        earlier = whole.rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns(_all(s.moments("prefix", earlier) for s in slots))
    # The last N rows before a row are a tail of the block of N rows before its own
    # block, and a head of its own block.  Both are running sums, and they merge
    # without subtracting, so the cost per row does not depend on N.
    n = config.max_training
    df = df.withColumn("_row", F.row_number().over(whole) - 1)
    df = df.withColumn("_block", F.floor(F.col("_row") / n))
    block = Window.partitionBy(*keys, "_block")
    head = block.orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    tail = block.orderBy(F.desc(ts)).rowsBetween(Window.unboundedPreceding, 0)
    # Blocks follow time, so this is the order of ``whole``; it shares a sort with ``head``.
    by_block = Window.partitionBy(*keys).orderBy("_block", ts)
    df = df.withColumns(_all(s.moments("tail", tail) for s in slots))
    df = df.withColumns(_carried(slots, config, n, by_block))
    return df.withColumns(_all(s.moments("prefix", head) for s in slots))


def _carried(slots: list[_Slot], config: BandConfig, n: int, window) -> dict[str, Column]:
    """The tail state of the row ``n`` places back."""
    carried = {}
    for s in slots:
        tails = state_columns(s.named("tail"), config.paired)
        names = state_columns(s.named("carry"), config.paired)
        carried |= {c: F.lag(t, n).over(window) for t, c in zip(tails, names, strict=True)}
    return carried


# Hours of the units of a span.
_UNIT_HOURS = {"second": 1 / 3600, "minute": 1 / 60, "hour": 1.0, "day": 24.0, "week": 168.0}


def span_hours(span: str) -> float:
    found = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day|week)s?\s*", span.lower())
    if not found or not int(found[1]):
        raise ValueError(f"a span is a number and a unit, such as '7 days'; got {span!r}")
    return int(found[1]) * _UNIT_HOURS[found[2]]


def _chunked(
    df: DataFrame, keys: list[str], ts: str, slots: list[_Slot], config: BandConfig, span: str
) -> DataFrame:
    """The same history, with no task holding more than one chunk of a key.

    The rows are stored once: the totals of the chunks and the rows that they are carried
    into both come from that table, not from the scan and the windows behind it.
    """
    # A struct equals itself also where a field is NULL, so no series and no row is lost.
    hours = hours_since(df, ts, config.time_origin)
    number = F.floor(hours / F.lit(span_hours(span)))
    df = df.withColumns({"_key": F.struct(*keys), "_chunk": F.struct(number.alias("n"))})
    df = create_table_as(df, shared_dir(df.sparkSession, "chunks"))
    chunk = Window.partitionBy("_key", "_chunk").orderBy(ts)
    chunks = Window.partitionBy("_key").orderBy("_chunk")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)

    if config.model == "ar1" or config.max_training is not None:
        ends = df.groupBy("_key", "_chunk").agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.max_by(s.y, F.struct(ts)).alias(s.named("last")) for s in slots],
        )
        ends = ends.select(
            "_key",
            "_chunk",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"),
            *[F.lag(s.named("last")).over(chunks).alias(s.named("last")) for s in slots],
        )
        df = df.join(ends, ["_key", "_chunk"])
        place = F.row_number().over(chunk)
        df = df.withColumn("_row", F.col("_rows") + place - 1)
        if config.model == "ar1":
            first = place == 1
            df = df.withColumns(
                {
                    s.x: F.when(first, F.col(s.named("last"))).otherwise(F.lag(s.y).over(chunk))
                    for s in slots
                }
            )

    if config.max_training is None:
        sums = df.groupBy("_key", "_chunk").agg(*_aliased(_all(s.moments("sum") for s in slots)))
        whole = chunks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        carries = _all(
            running_total(s.named("sum"), config.paired, whole, before).columns(s.named("carry"))
            for s in slots
        )
        df = df.join(sums.select("_key", "_chunk", *_aliased(carries)), ["_key", "_chunk"])
        earlier = chunk.rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns(_all(s.moments("prefix", earlier) for s in slots))

    # Each row goes to its own block and, as a helper, to the next one, so a task
    # needs two blocks of N rows to know the N rows before every row of the second.
    n = config.max_training
    df = df.withColumn("_helper", F.explode(F.array(F.lit(0), F.lit(1))))
    df = df.withColumn("_block", F.floor(F.col("_row") / n) + F.col("_helper"))
    block = Window.partitionBy("_key", "_block")
    head = block.orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    tail = block.orderBy(F.desc("_row")).rowsBetween(Window.unboundedPreceding, 0)
    helps = F.col("_helper") == 1
    df = df.withColumns(_all(s.moments("tail", tail, only=helps) for s in slots))
    df = df.withColumns(_carried(slots, config, n, block.orderBy("_row")))
    df = df.withColumns(_all(s.moments("prefix", head, only=~helps) for s in slots))
    return df.where(~helps)


def _band(slot: _Slot, config: BandConfig) -> Column:
    m = read_moments(slot.named("state"), config.paired)
    n = m.n.cast("double")
    if config.model == "mean":
        forecast = m.my
        spread = F.sqrt(F.try_divide(m.syy, n - 1))
    else:
        slope = F.try_divide(m.sxy, F.nullif(m.sxx, F.lit(0.0)))
        forecast = m.my + slope * (F.col(slot.x) - m.mx)
        rest = F.greatest(m.syy - slope * m.sxy, F.lit(0.0))
        spread = F.sqrt(F.try_divide(rest, n - 2))
    trained = m.n >= config.min_training
    half = F.lit(config.z) * spread
    upper = F.when(trained, forecast + half)
    lower = F.when(trained, forecast - half)
    y = slot.y
    return F.struct(
        F.when(trained, forecast).alias("forecast_value"),
        upper.alias("upper_bound"),
        lower.alias("lower_bound"),
        F.coalesce((y > upper) | (y < lower), F.lit(False)).alias("is_anomaly"),
        m.n.cast("bigint").alias("training_size"),
    )


def anomaly_records(
    df: DataFrame,
    keep: Sequence[str],
    value: str = "observed_value",
    band: str = "r",
    sides: str = "both",
) -> DataFrame:
    """Only the anomalies: observed, expected (two decimals), bounds, deviation, direction.

    ``sides`` is ``both``, ``high`` or ``low``.
    """
    observed, r = F.col(value), lambda f: F.col(f"{band}.{f}")
    found = df.where(r("is_anomaly"))
    if sides == "high":
        found = found.where(observed > r("upper_bound"))
    elif sides == "low":
        found = found.where(observed < r("lower_bound"))
    elif sides != "both":
        raise ValueError("sides is both, high or low")
    return found.select(
        *keep,
        observed.alias("observed_value"),
        round_half_up(r("forecast_value"), 2).alias("expected_value"),
        r("upper_bound").alias("upper_bound"),
        r("lower_bound").alias("lower_bound"),
        (observed - r("forecast_value")).alias("deviation"),
        direction_label(observed, r("upper_bound"), r("lower_bound")).alias("direction"),
    )


def union_branches(*branches: DataFrame) -> DataFrame:
    """UNION ALL by position; names come from the first branch."""
    first, *rest = branches
    for branch in rest:
        first = first.unionAll(branch)
    return first
