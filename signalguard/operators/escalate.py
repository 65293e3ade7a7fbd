"""Roll signal anomalies up to entities on which several signals tripped together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalguard.operators.windows import tumble


def signal_mask(signals: Sequence[str], signal: str = "signal") -> Column:
    """The set of signals that occur, as an aggregate of fixed size.

    Bit ``i`` stands for the i-th of the listed signals in alphabetical order; others are in
    no bit.  Partial masks merge by OR, so neither a shuffle nor a stream's state holds a
    list per group, and the aggregation stays a hash aggregation.
    """
    bits = F.lit(0).cast("bigint")
    for i, name in reversed(list(enumerate(_bit_order(signals)))):
        bits = F.when(F.col(signal) == name, F.lit(1 << i).cast("bigint")).otherwise(bits)
    return F.bit_or(bits)


def _bit_order(signals: Sequence[str]) -> list[str]:
    order = sorted(set(signals))
    if len(order) > 63:
        raise ValueError("a mask has room for 63 signals")
    return order


def mask_count(mask: Column) -> Column:
    """How many signals a mask holds."""
    return F.bit_count(mask).cast("bigint")


def mask_names(mask: Column, signals: Sequence[str], separator: str = ", ") -> Column:
    """The signals of a mask as text, in alphabetical order."""
    names = [
        F.when(mask.bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, name)
        for i, name in enumerate(_bit_order(signals))
    ]
    return F.concat_ws(separator, *names)


def distinct_signals(signal: str = "signal", signals: Sequence[str] | None = None) -> Column:
    """COUNT(DISTINCT), exact; usable on a stream because the set of signals is small.

    With ``signals``, all that may occur, as a mask.
    """
    if signals is not None:
        return mask_count(signal_mask(signals, signal))
    return F.size(F.collect_set(signal)).cast("bigint")


def list_signals(
    signal: str = "signal", separator: str = ", ", signals: Sequence[str] | None = None
) -> Column:
    """Distinct signals as text, in alphabetical order; with ``signals``, as a mask."""
    if signals is not None:
        return mask_names(signal_mask(signals, signal), signals, separator)
    return F.array_join(F.sort_array(F.collect_set(signal)), separator)


def signal_pivot(
    signals: Sequence[str], signal: str = "signal", value: str = "observed_value"
) -> list[Column]:
    """One column per listed signal: its largest value, NULL if it did not occur."""
    return [F.max(F.when(F.col(signal) == s, F.col(value))).alias(s) for s in signals]


def escalate(
    anomalies: DataFrame,
    entity: str,
    signals: Sequence[str],
    ts: str = "window_time",
    width: str = "5 minutes",
    min_signals: int = 2,
) -> DataFrame:
    """Entities with at least ``min_signals`` distinct signals in one window.

    Only the listed signals count.
    """
    known = list(dict.fromkeys(signals))
    rolled = tumble(
        anomalies,
        ts,
        width,
        [entity],
        [
            distinct_signals(signals=known).alias("signals_tripped"),
            list_signals(signals=known).alias("tripped_signals"),
            *signal_pivot(known),
        ],
    )
    return rolled.where(F.col("signals_tripped") >= min_signals).drop("window_time")
