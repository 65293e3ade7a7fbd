"""A table of finished calls, so that a call with cost or side effects is made once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalguard.sources.tables import scan

_CALLS = (
    T.StructType()
    .add("key", T.StringType())
    .add("response", T.StringType())
    .add("delivery", T.LongType())
)


@dataclass(frozen=True)
class Ledger:
    """Calls by key, their response, and the delivery (such as a batch id) that made them.

    A call is finished when its response is in the table; rows whose key is there get that
    response and no new call.  Within a delivery, rows of one key share one call.  What a
    lost task had called without storing is called again, so tools should still drop repeats
    of a key: the ledger bounds such repeats to one delivery's running tasks.
    """

    spark: SparkSession
    path: str
    delivery: int = 0

    def __post_init__(self):
        self.spark.createDataFrame([], _CALLS).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        return scan(self.spark, self.path, _CALLS)

    def call(
        self, df: DataFrame, key: Column, call: Callable[[DataFrame], DataFrame], out: str
    ) -> DataFrame:
        """``df`` with the response of each row's key in ``out``; NULL for a NULL key.

        ``call`` adds ``out`` to the rows it gets, one for each key that is not finished.
        """
        keyed = df.withColumn("_key", key)
        todo = keyed.where(F.col("_key").isNotNull()).dropDuplicates(["_key"])
        done = self.rows().select(F.col("key").alias("_key"))
        fresh = call(todo.join(done, "_key", "left_anti"))
        fresh.select(
            F.col("_key").alias("key"),
            F.col(out).alias("response"),
            F.lit(self.delivery).cast("bigint").alias("delivery"),
        ).write.mode("append").parquet(self.path)
        known = self.rows().select(F.col("key").alias("_key"), F.col("response").alias(out))
        return keyed.join(known, "_key", "left").drop("_key")
