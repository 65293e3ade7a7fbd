"""Row numbers within groups, without a group ever being in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalguard.llm.base import stored


def numbered(df: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """Add ``pos``, the row's place in its group from 0, and ``n``, the group's rows.

    Rows are dealt out by ranges of (group, order), so a group may span many tasks; each
    numbers its own rows, and the row counts of group and task, a small table, say where a
    task's part of a group begins.  NULL sorts first.  Rows alike in ``order`` get places in
    any order: name enough columns.  ``group`` is a struct, so that NULL equals NULL in the
    join.  The rows are stored below the shared folder: places cannot change when a lost
    task is run again.
    """
    keys = [group, *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = stored(
        dealt.select(
            "*",
            F.spark_partition_id().alias("part"),
            # The low 33 bits count the rows of a partition.
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"),
        ),
        label,
    )
    sizes = rows.groupBy(group, "part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("at").alias("first")
    )
    parts = Window.partitionBy(group).orderBy("part")
    before = F.sum("rows").over(parts.rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("rows").over(Window.partitionBy(group))
    sizes = sizes.select(
        group,
        "part",
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
        total.alias("n"),
    )
    return rows.join(sizes, [group, "part"]).select(
        *df.columns, (F.col("at") + F.col("shift")).alias("pos"), "n"
    )
