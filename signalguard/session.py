"""Session helpers: shared scratch folders and temporary settings."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Tasks to a core where rows are dealt out, so that each one holds a small part of them.
TASKS_PER_CORE = 8
#: Bytes to a task there, as the planner estimates them: those of files, which are compressed.
TASK_BYTES = 2 << 20
#: More tasks than this take longer to start than they save.
MOST_TASKS = 20_000
#: No task gets more than this, however few tasks were asked for.
MOST_BYTES = 16 << 20
#: Up to so many parts a shuffle writes rows as they come, to a file each; it holds them for more.
UNHELD_PARTS = 200


def shared_dir(spark: SparkSession, label: str) -> str:
    """The path of a folder, not yet made, that every executor can reach.

    It lies under ``spark.checkpoint.dir``.  Where that is unset a machine-local
    folder is used, but only in local mode, where driver and executors share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{tempfile.mkdtemp(prefix=f'{label}-')}/table"


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Set run-time options (``__`` stands for a dot) and put the old ones back."""
    wanted = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def planned_bytes(df: DataFrame) -> int | None:
    """The size of the rows as the planner estimates it, or None where it has no idea."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size <= 1 << 50 else None


def dealt(df: DataFrame, *columns: str, most: int = MOST_TASKS) -> DataFrame:
    """The rows in many small tasks, equal values of the columns together.

    The planner makes tasks as large as a split or a shuffle's advisory size allows, and sorts
    and hash tables hold several times that.  Their number grows with the input, so that what
    a task holds does not: ``most`` tasks are made while they are not too large.
    """
    least = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    size = planned_bytes(df)
    if size is None:
        return df.repartition(least, *columns)
    most = max(most, math.ceil(size / MOST_BYTES))
    return df.repartition(max(least, min(math.ceil(size / TASK_BYTES), most)), *columns)
