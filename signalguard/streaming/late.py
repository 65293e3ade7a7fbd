"""Late rows as data: which rows came after their window had closed, and when it had."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from signalguard.operators.detect import span_hours
from signalguard.sources.tables import scan
from signalguard.streaming.run import start_actions, write_once

_MARK = T.StructType().add("newest", T.TimestampType())


def start_late_split(
    df: DataFrame,
    ts: str,
    width: str,
    delay: str,
    accepted: str,
    late: str,
    marks: str,
    checkpoint: str,
    pauses: bool = True,
    **trigger,
) -> StreamingQuery:
    """Split a stream by the watermark that its micro-batches make.

    The watermark is the newest time of all earlier micro-batches, cut to milliseconds, less
    ``delay``.  A row is late if the window of ``width`` it belongs to ends no later than
    that: a windowed aggregation of the same batches has let the window go, would drop the
    row and only count it.  Late rows go to ``late`` with the ``watermark`` they met, all
    others, rows without a time among them, to ``accepted``; ``marks`` keeps one row per
    batch.  Every row is in one table, once, also when a batch is retried.  ``df`` has no
    watermark of its own.

    Where the source ``pauses`` after a micro-batch, Spark lets windows go before the next.
    Of batches back to back (``pauses=False``) one lets them go after it took its own rows,
    so the batch just before does not count yet.
    """
    behind = 1 if pauses else 2

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        time = F.col(ts).cast("timestamp")
        newest = _newest_upto(spark, marks, batch_id - behind)
        held = batch.persist()
        try:
            mark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
            # Without an earlier batch the mark is NULL, and no row is late.
            is_late = F.coalesce(_window_end(time, width) <= mark, F.lit(False))
            write_once(held.where(~is_late), f"{accepted}/batch_id={batch_id}")
            write_once(
                held.where(is_late).withColumn("watermark", mark), f"{late}/batch_id={batch_id}"
            )
            here = F.max(F.date_trunc("millisecond", time))
            before = F.lit(_newest_upto(spark, marks, batch_id - 1)).cast("timestamp")
            known = held.agg(F.greatest(here, before).alias("newest"))
            write_once(known, f"{marks}/batch_id={batch_id}")
        finally:
            held.unpersist()

    return start_actions(df, split, checkpoint, **trigger)


def _window_end(time: Column, width: str) -> Column:
    """The end of the epoch-aligned window; unlike ``window``, keeps rows without a time."""
    size = F.lit(round(span_hours(width) * 3.6e9))
    micros = F.unix_micros(time)
    return F.timestamp_micros(micros - F.pmod(micros, size) + size)


def _newest_upto(spark: SparkSession, marks: str, batch_id: int):
    """The newest time of the batches up to one; each mark covers all earlier ones."""
    if batch_id < 0:
        return None
    return scan(spark, f"{marks}/batch_id={batch_id}", _MARK).first()["newest"]
