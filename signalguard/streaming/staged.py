"""A chain of streaming jobs, each reading the table that the one before it writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalguard.sources.tables import END, EndOfInput, scan_stream
from signalguard.streaming.run import drain, start_table


@dataclass(frozen=True)
class Stage:
    """One job: its table's name and what it does with the table before it.

    ``ts`` is the time column of its input, whose watermark the job keeps for itself; None
    for a job that keeps no state.
    """

    name: str
    apply: Callable[[DataFrame], DataFrame]
    ts: str | None = None


class StagedTables:
    """The jobs of a pipeline below one folder, each with a checkpoint of its own.

    A job may be stopped and started between and during micro-batches: it goes on from its
    checkpoint, and reads only what the job before has committed.  ``advance`` lets every job
    process what is there; ``close`` also ends the input, job after job, so that all windows
    come out.  The same ``root`` and stages continue an earlier run.
    """

    def __init__(
        self,
        source: Callable[[EndOfInput | None], DataFrame],
        root: str,
        stages: Sequence[Stage],
        end: EndOfInput,
        delay: str = "5 seconds",
        files_per_trigger: int | None = None,
    ):
        """``source(end)`` is the first job's input as a stream that ``end`` can close."""
        self.source, self.root, self.stages = source, root, list(stages)
        self.end, self.delay, self.files = end, delay, files_per_trigger

    def advance(self, upto: str | None = None) -> None:
        self._run(closing=False, upto=upto)

    def close(self) -> None:
        self._run(closing=True, upto=None)

    def table(self, name: str, spark: SparkSession) -> DataFrame:
        """A scan of a stage's table."""
        return spark.read.parquet(f"{self.root}/{name}")

    def _run(self, closing: bool, upto: str | None) -> None:
        stream, end = self.source(self.end), self.end
        for stage in self.stages:
            result = stage.apply(self._without_end(stream, stage))
            path, checkpoint = f"{self.root}/{stage.name}", f"{self.root}/{stage.name}-checkpoint"
            drain(
                lambda: start_table(result, path, checkpoint),  # noqa: B023
                end if closing and stage.ts else None,
                at_once=self.files is None,
            )
            if stage.name == upto:
                return
            following = self.stages[self.stages.index(stage) + 1 :]
            if not following:
                return
            end = None
            if following[0].ts:
                end = EndOfInput(
                    result.sparkSession, f"{path}-end", result.schema, following[0].ts
                )
            stream = scan_stream(
                result.sparkSession,
                path,
                result.schema,
                following[0].ts,
                self.delay,
                self.files,
                end,
            )

    @staticmethod
    def _without_end(stream: DataFrame, stage: Stage) -> DataFrame:
        """A filter on the time stays behind the watermark, so the closing row still moves it."""
        if stage.ts is None:
            return stream
        time = F.col(stage.ts)
        return stream.where(time.isNull() | (time < F.lit(END).cast("timestamp")))

