"""Tables: declared-schema scans, contracts, and sinks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table read with a declared schema: no inference job, pruned columns."""
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class EndOfInput:
    """A folder beside a stream's table whose one row says that no more will come.

    A watermark trails the newest row, so the last windows of a bounded table would stay open
    for ever.  The row lies far in the future: it moves the watermark past every window.  Its
    own window never closes, so it shows in no windowed result; without a window, drop rows
    from ``END`` on.  Put filters behind the first window: one that the row does not
    pass would be moved before the watermark and hold it back.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    ts: str

    def __post_init__(self):
        self._write([])

    def mark(self) -> None:
        self._write([{self.ts: END}])

    def _write(self, rows: list[dict]) -> None:
        fields = [T.StructField(f.name, f.dataType) for f in self.schema.fields]
        row = self.spark.createDataFrame(rows, T.StructType(fields))
        row.coalesce(1).write.mode("append").parquet(self.path)


END = dt.datetime(9000, 1, 1)


def scan_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    ts: str | None = None,
    delay: str = "5 seconds",
    files_per_trigger: int | None = None,
    end: EndOfInput | None = None,
) -> DataFrame:
    """The same table as a stream, from its first file on, with an event-time watermark.

    A zone-less time column becomes a timestamp, since a watermark needs one.  With ``end``
    the stream can be closed; see ``run_to_end``.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.parquet(path)
    if end is not None:
        df = df.unionByName(spark.readStream.schema(schema).parquet(end.path))
    if ts is None:
        return df
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def split_not_null(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all of the columns set, and the rows rejected."""
    ok = all_set(columns)
    return df.where(ok), df.where(~ok)


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(all_set(columns))


def all_set(columns: Sequence[str]) -> Column:
    ok = F.lit(True)
    for name in columns:
        ok = ok & F.col(name).isNotNull()
    return ok


def json_list_rejects(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is there but is no JSON array of strings."""
    parsed = F.from_json(F.col(column), "array<string>")
    return df.where(F.col(column).isNotNull() & parsed.isNull())


def read_json_list(spark: SparkSession, path: str, out: str) -> DataFrame:
    """One row per element of files that each hold one JSON array of strings."""
    return explode_json_list(spark.read.text(path, wholetext=True), "value", out).select(out)


def explode_json_list(df: DataFrame, column: str, out: str) -> DataFrame:
    """One row per element of a JSON array of strings.

    NULL and empty lists have no rows; ``json_list_rejects`` has the malformed ones.
    """
    return df.withColumn(out, F.explode(F.from_json(F.col(column), "array<string>")))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to declared columns, in their order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def create_table_as(
    df: DataFrame,
    path: str,
    schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> DataFrame:
    """Write a result table and return a scan of it; with ``schema``, declared columns."""
    if schema is not None:
        df = conform(df, schema)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return scan(df.sparkSession, path, df.schema)


def append_to_table(df: DataFrame, path: str, key: str, default: str = "UNKNOWN") -> None:
    """Append rows; the key is filled but not enforced, so repeats stay."""
    df.withColumn(key, F.coalesce(F.col(key), F.lit(default))).write.mode("append").parquet(path)


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Drop exactly the catalog tables named."""
    for name in names:
        quoted = ".".join(f"`{part}`" for part in name.split("."))
        spark.sql(f"DROP TABLE IF EXISTS {quoted}")
