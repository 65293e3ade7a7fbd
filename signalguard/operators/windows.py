"""Tumbling event-time windows and running frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalguard.session import UNHELD_PARTS, dealt


def tumble(
    df: DataFrame,
    ts: str,
    width: str,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    sparse: bool = False,
) -> DataFrame:
    """Aggregate per key and epoch-aligned window ``[start, end)``.

    Rows are combined before the shuffle, so a hot key costs one partial row per
    window and task.  ``window_time`` is the last instant of the window and keeps the
    watermark of a stream; use ``public_window_time`` on it after the last window.

    ``sparse`` tables have about a row to a window, so combining saves nothing, and the
    session's number of shuffle partitions would bound how small a part of the windows a task
    holds.  Their rows are dealt out by key and window instead, to tasks whose number grows
    with the input, and combined there.
    """
    window = F.window(F.col(ts), width)
    if sparse:
        df = dealt(df.withColumn("_window", window), *keys, "_window", most=UNHELD_PARTS)
        window = F.col("_window")
    grouped = df.groupBy(window.alias("window"), *keys).agg(*aggregates)
    return grouped.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.window_time("window").alias("window_time"),
        *grouped.columns[1 + len(keys) :],
    )


def average_signals(
    df: DataFrame,
    ts: str,
    width: str,
    entity: str,
    signals: Sequence[str],
    sparse: bool = False,
) -> DataFrame:
    """One row per entity and window with the mean of every signal; NaN is no reading."""
    read = lambda s: F.nanvl(F.col(s).cast("double"), F.lit(None).cast("double"))
    return tumble(df, ts, width, [entity], [F.avg(read(s)).alias(s) for s in signals], sparse)


def window_profile(
    df: DataFrame,
    ts: str,
    width: str,
    entity: str,
    value: str,
    others: Sequence[str] = (),
    sparse: bool = False,
) -> DataFrame:
    """Mean and maximum of one signal, means of others, and the reading count."""
    return tumble(
        df,
        ts,
        width,
        [entity],
        [
            F.avg(value).alias(f"avg_{value}"),
            F.max(value).alias(f"max_{value}"),
            *[F.avg(o).alias(f"avg_{o}") for o in others],
            F.count(F.lit(1)).alias("reading_count"),
        ],
        sparse,
    )


def public_window_time(column: str | Column = "window_time") -> Column:
    """Window time as shown in results: one millisecond before the window's end."""
    c = F.col(column) if isinstance(column, str) else column
    return c - F.expr("INTERVAL '0.000999' SECOND")


def running_frame(
    df: DataFrame, keys: Sequence[str], ts: str, aggregates: dict[str, Column]
) -> DataFrame:
    """Aggregates over all rows of a key up to and including the current time.

    A RANGE frame: rows with the same time see each other.  Give it windowed rows, so
    that a key holds at most one row per window.
    """
    frame = (
        Window.partitionBy(*keys)
        .orderBy(ts)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumns({name: agg.over(frame) for name, agg in aggregates.items()})
