"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalguard.session import settings, shared_dir
from signalguard.sources.tables import create_table_as

# Maps each byte to itself, A-Z to a-z.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once below the shared folder and read again.

    Cuts the lineage: a lost executor costs no recomputation, and every later reader sees
    the same rows.  What was shuffled for it is removed once it is written; Spark would keep
    that until the driver happens to collect garbage.
    """
    spark = df.sparkSession
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        return create_table_as(df, shared_dir(spark, label))


def forget(df: DataFrame) -> None:
    """Remove a table that ``stored`` wrote, once all that was made from it is stored itself."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(column: str | Column, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; NULL for a NULL id."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(c.cast("string").cast("binary")) % parts


def is_fold(column: str | Column, parts: int, rest: int) -> Column:
    """Whether the row is in the fold; a NULL id is in none."""
    return F.coalesce(fold(column, parts) == rest, F.lit(False))


def utf8(column: str) -> Column:
    """Text as UTF-8 bytes, NULL as empty."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> Iterator[tuple]:
    """(first row, values) of consecutive rows of a binary column, some megabytes at a time."""
    values = batch.column(column)
    start, size = 0, 0
    found: list[bytes] = []
    for i in range(len(values)):
        value = values[i].as_py() or b""
        found.append(value)
        size += len(value)
        if size >= most_bytes:
            yield start, found
            start, size, found = i + 1, 0, []
    if found:
        yield start, found


def as_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no name of theirs can clash with working columns."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def from_row(columns: list[str], row: str = "row", **changed: Column) -> list[Column]:
    """The columns of such a struct again, some of them changed."""
    return [changed.get(name, F.col(row).getField(name)).alias(name) for name in columns]


class Shared:
    """A broadcast object whose class need not be installed where it is read."""

    def __init__(self, spark: SparkSession, value: object):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def load(self):
        return cloudpickle.loads(self._sent.value)
