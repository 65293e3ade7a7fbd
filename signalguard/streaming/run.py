"""Starting streaming jobs and their result tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from signalguard.session import planned_bytes, settings
from signalguard.sources.tables import EndOfInput, scan, split_not_null

#: State partitions to a core, so that the groups of one are a small part of them.
STATE_PER_CORE = 4
#: Bytes of a replayed table to a state partition, as the planner estimates them.
STATE_BYTES = 8 << 20
#: Bytes of files that a task reads: it combines their rows in a hash table of many times that.
SPLIT = "16m"
COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
UNLOADED = "spark.sql.streaming.stateStore.unloadOnCommit"
#: State that an executor's partitions hold in memory, all of them together; it is not in the heap.
STATE_MB = 256
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def stream_session(
    spark: SparkSession, state_partitions: int | None = None, replay: DataFrame | None = None
):
    """UTC, RocksDB state, and a fixed number of state partitions while a job is started.

    Micro-batches upload the changes of the state, not whole snapshots of it.  The number
    of state partitions is fixed for the life of a checkpoint; by default it is four times the
    cluster's core count.  ``replay`` is a stored table that comes in one micro-batch, so its
    size says how many more there are: what a state partition holds does not grow with it.  Its
    state is not counted (``numRowsTotal``), which would cost a read for every write, and a
    partition's store is closed when its task is done: few are read again, and an executor that
    kept them all open would hold as much memory as the whole table needs.  What the open ones
    hold is bounded in any case.
    """
    parts = state_partitions or STATE_PER_CORE * spark.sparkContext.defaultParallelism
    if state_partitions is None and replay is not None:
        parts = max(parts, math.ceil((planned_bytes(replay) or 0) / STATE_BYTES))
    at_once = {} if replay is None else {COUNTED: "false", UNLOADED: "true"}
    with settings(
        spark,
        **at_once,
        spark__sql__streaming__stateStore__providerClass=ROCKSDB,
        spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
        spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage="true",
        spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB=str(STATE_MB),
        spark__sql__session__timeZone="UTC",
        spark__sql__shuffle__partitions=str(parts),
        spark__sql__files__maxPartitionBytes=SPLIT,
    ):
        yield spark


def start_table(
    df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, **trigger
) -> StreamingQuery:
    """A continuous append-only result table; ``trigger`` as in ``DataStreamWriter.trigger``."""
    writer = df.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_actions(
    df: DataFrame, act: Callable[[DataFrame, int], None], checkpoint: str, **trigger
) -> StreamingQuery:
    """Hand each micro-batch to ``act(batch, batch_id)``; a retried batch keeps its id."""
    return (
        df.writeStream.foreachBatch(act)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_written_steps(
    df: DataFrame,
    steps: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]],
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Apply (path, step) pairs to each micro-batch; a step reads what the one before wrote.

    For calls with cost or side effects: no call's result is used before it is stored, and
    a retried batch takes up its work after the last step it had finished.  A batch owns the
    folder ``batch_id=<n>`` of each path, so a path belongs to one checkpoint: the batches
    of another would be taken for done.
    """

    def act(batch: DataFrame, batch_id: int) -> None:
        for path, step in steps:
            batch = write_once(step(batch), f"{path}/batch_id={batch_id}")

    return start_actions(df, act, checkpoint, **trigger)


def write_once(result: DataFrame, folder: str) -> DataFrame:
    """Write a folder unless a write of it has been committed before; a scan of it."""
    spark = result.sparkSession
    if not committed(spark, folder):
        result.write.mode("overwrite").parquet(folder)
    return scan(spark, folder, result.schema)


def committed(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder ran to its end: committers leave a mark there."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def start_split(
    df: DataFrame, columns: Sequence[str], accepted: str, rejected: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """One stream to two tables: rows with all of ``columns`` set, and the rows rejected.

    Every row is in one of them, once: a micro-batch writes a folder of its own in each, and
    a retried one writes only those it had not finished.  Read them by ``scan_batches``.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for path, part in zip((accepted, rejected), split_not_null(held, columns), strict=True):
                write_once(part, f"{path}/batch_id={batch_id}")
        finally:
            held.unpersist()

    return start_actions(df, split, checkpoint, **trigger)


def scan_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of ``batch_id=<n>`` folders, without that column."""
    return scan(spark, path, schema).select(*schema.fieldNames())


def drain(
    start: Callable[[], StreamingQuery], end: EndOfInput | None = None, at_once: bool = False
) -> None:
    """Process what is available; with ``end``, then close the input and every window.

    The closing is a second run from the same checkpoint, after all rows: the watermark
    cannot overtake rows that are still waiting, however many micro-batches they make.
    ``at_once`` closes in the first run, which is right only where everything there is makes
    one micro-batch, that is without a limit of files per trigger.
    """
    if end is not None and at_once:
        end.mark()
    start().awaitTermination()
    if end is not None and not at_once:
        end.mark()
        start().awaitTermination()


def run_to_end(
    df: DataFrame,
    path: str,
    checkpoint: str,
    end: EndOfInput | None = None,
    at_once: bool = False,
) -> DataFrame:
    """Process what is available into a table and return a scan of it."""
    drain(lambda: start_table(df, path, checkpoint), end, at_once)
    return scan(df.sparkSession, path, df.schema)
