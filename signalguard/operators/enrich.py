"""Row functions backed by an external model: inference and tool-using agents.

Only the text goes to Python; all other columns stay in the JVM.  Calls run at least
once, so write their result to a table before acting on it.
"""

from __future__ import annotations

import re
import socket
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Model = Callable[[pd.Series], pd.Series]


def lateral_apply(
    df: DataFrame,
    row_function: Callable[[pd.DataFrame], pd.DataFrame],
    added: T.StructType,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Cross-apply: each row gets the columns the function returns for it.

    Only ``columns`` (all by default) go to Python; the others stay in the JVM.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            extra = row_function(batch)
            if len(extra) != len(batch):
                raise ValueError("a lateral function returns one row per input row")
            yield extra.reset_index(drop=True)[added.fieldNames()]

    run.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    call = F.pandas_udf(run, added)
    given = F.struct(*(columns or df.columns))
    rows = df.select(F.struct(*df.columns).alias("row"), call(given).alias("added"))
    return rows.select("row.*", "added.*")


def ml_predict(
    df: DataFrame,
    model_factory: Callable[[], Model],
    prompt: Column | str,
    out: str = "response",
    batch_size: int = 256,
    tasks: int | None = None,
) -> DataFrame:
    """Add the model's answer to each row's prompt; a NULL prompt gets a NULL answer.

    ``model_factory`` runs once per task and returns a function from a Series of
    prompts to a Series of answers, called with at most ``batch_size`` prompts.
    ``tasks`` is explained at ``spread``.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_factory()
        for prompts in batches:
            answers = pd.Series([None] * len(prompts), dtype=object)
            given = prompts.reset_index(drop=True).dropna()
            for start in range(0, len(given), batch_size):
                part = given.iloc[start : start + batch_size]
                answers.loc[part.index] = model(part).to_numpy()
            yield answers

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    call = F.pandas_udf(run, T.StringType())
    text = F.col(prompt) if isinstance(prompt, str) else prompt
    return spread(df, tasks).withColumn(out, call(text))


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Deal rows out evenly before slow calls: to all cores by default, not at all with 0.

    Escalated rows are few and small, so the planner would put them into a handful of
    partitions, and a hot entity's rows next to each other.
    """
    if tasks is None:
        tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if tasks else df


@dataclass(frozen=True)
class RuleModel:
    """An offline model: severity from the number of signals named in the prompt.

    ``severities`` gives the least number of signals of each severity; fewer are LOW.
    """

    severities: Mapping[int, str] = field(
        default_factory=lambda: {4: "CRITICAL", 3: "HIGH", 2: "MEDIUM"}
    )
    actions: Mapping[str, str] = field(
        default_factory=lambda: {
            "CRITICAL": "stop at the nearest service center",
            "HIGH": "repair today",
            "MEDIUM": "repair at the next stop",
            "LOW": "keep watching",
        }
    )

    def severity(self, signals: int) -> str:
        reached = [least for least in self.severities if signals >= least]
        return self.severities[max(reached)] if reached else "LOW"

    def __call__(self, prompts: pd.Series) -> pd.Series:
        count = prompts.str.extract(r"\((\d+) distinct signals\)", expand=False)
        signals = prompts.str.extract(r"Outside the band: ([^(\n]+) \(", expand=False)
        severity = count.map(lambda c: self.severity(int(c)), na_action="ignore")
        severity = severity.fillna("LOW")
        return (
            "SEVERITY: "
            + severity
            + "\nLIKELY_CAUSE: joint fault behind "
            + signals.fillna("unknown signals")
            + "\nRECOMMENDED_ACTION: "
            + severity.map(self.actions)
        )


@dataclass(frozen=True)
class ToolCall:
    name: str
    arguments: dict


@dataclass(frozen=True)
class Observation:
    """What a tool call returned; ``ok`` is False when it failed or is not allowed.

    ``reachable`` is False when no reply came: no connection, or no answer in time.  After
    the latter, ``timed_out``, what was asked for may still have been done.
    """

    call: ToolCall
    ok: bool
    text: str
    reachable: bool = True
    timed_out: bool = False


def immediate(tool: Callable[[dict, str, float], str]) -> Callable[[dict, str, float], str]:
    """Marks a tool that never waits: it is called without a thread, which costs much more."""
    tool.immediate = True
    return tool


class ToolThreads:
    """At most ``size`` tool calls at a time; a call that hangs is left to its thread.

    When as many calls hang as there are threads, new threads take their place, so one dead
    service costs threads, never the task.
    """

    def __init__(self, size: int = 1):
        self.size, self.hung = size, 0
        self.pool = ThreadPoolExecutor(max_workers=size)

    def call(self, tool: Callable[[dict, str, float], str], *arguments, timeout: float) -> str:
        asked = self.pool.submit(tool, *arguments)
        try:
            return asked.result(timeout=timeout)
        except TimeoutError:
            if not asked.done():
                self.hung += 1
                if self.hung >= self.size:
                    self.close()
                    self.hung, self.pool = 0, ThreadPoolExecutor(max_workers=self.size)
            raise

    def close(self) -> None:
        self.pool.shutdown(wait=False)


def _no_reply(error: Exception) -> bool:
    """Whether nobody answered; an HTTP error has a code, a missing file is a fault of ours."""
    reason = getattr(error, "reason", error)
    silence = (ConnectionError, TimeoutError, socket.gaierror)
    return isinstance(reason, silence) and not hasattr(error, "code")


@dataclass(frozen=True)
class AgentSpec:
    """``step(instructions, input, key, seen)`` returns the next ToolCall or the answer.

    Tools are functions of ``(arguments, key, timeout_seconds)`` that return text.
    """

    name: str
    step: Callable[[str, str, str, list[Observation]], ToolCall | str]
    tools: Mapping[str, Callable[[dict, str, float], str]]
    instructions: str = ""
    max_iterations: int = 10
    request_timeout: float = 30.0

    def use(
        self,
        call: ToolCall,
        key: str,
        replies: Mapping[str, str | None] | None = None,
        threads: ToolThreads | None = None,
    ) -> Observation:
        """The tool's reply; ``replies`` are those already known, by tool."""
        if replies and call.name in replies:
            known = replies[call.name]
            return Observation(call, known is not None, known or "nothing is known")
        tool = self.tools.get(call.name)
        if tool is None:
            return Observation(call, False, f"tool {call.name} is not allowed")
        at_once = getattr(tool, "immediate", False)
        own = None if at_once else threads or ToolThreads()
        try:
            limit = self.request_timeout
            if own is None:
                return Observation(call, True, tool(call.arguments, key, limit))
            return Observation(
                call, True, own.call(tool, call.arguments, key, limit, timeout=limit)
            )
        except Exception as error:  # a failing tool is an answer for the agent, not for Spark
            text, late = f"{type(error).__name__}: {error}", isinstance(error, TimeoutError)
            return Observation(call, False, text, not _no_reply(error), late)
        finally:
            if own is not None and threads is None:
                own.close()

    def run(
        self,
        text: str,
        key: str,
        replies: Mapping[str, str | None] | None = None,
        threads: ToolThreads | None = None,
    ) -> str | None:
        """The agent's answer; None when it has none after ``max_iterations`` steps."""
        seen: list[Observation] = []
        for _ in range(self.max_iterations):
            move = self.step(self.instructions, text, key, seen)
            if isinstance(move, str):
                return move
            seen.append(self.use(move, key, replies, threads))
        return None


def run_agent(
    df: DataFrame,
    spec: AgentSpec,
    text: Column | str,
    key: Column | str,
    out: str = "response",
    concurrency: int = 1,
    tasks: int | None = None,
    replies: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """Run the agent on each row; a row without input gets a NULL answer.

    ``concurrency`` rows of a task are in flight together, which pays when tools wait
    on a network; mark tools that do not as ``immediate``.  ``replies`` names tools whose reply is a column of the row, found by a
    join before: such a tool answers from tables and calls nobody; a NULL is no reply.
    """
    known_replies = dict(replies or {})
    names = list(known_replies)

    def one(text: str | None, key: str | None, threads: ToolThreads, *known) -> str | None:
        if text is None:
            return None
        return spec.run(text, key, dict(zip(names, known, strict=True)), threads)

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        threads = ToolThreads(concurrency)
        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            for texts, keys, *known in batches:
                columns = [_nullable(c) for c in (texts, keys, *known)]
                each = map if concurrency == 1 else pool.map
                answers = each(
                    lambda row: one(row[0], row[1], threads, *row[2:]),
                    zip(*columns, strict=True),
                )
                yield pd.Series(list(answers), dtype=object)
        threads.close()

    run.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, ...]],
        "return": Iterator[pd.Series],
    }
    call = F.pandas_udf(run, T.StringType())
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    arguments = [as_column(c) for c in (text, key, *known_replies.values())]
    return spread(df, tasks).withColumn(out, call(*arguments))


def _nullable(values: pd.Series) -> list[str | None]:
    return [None if pd.isna(v) else v for v in values]


def input_fields(text: str) -> dict[str, str]:
    """The ``name: value`` pairs of an agent input, as text; of equal names the first."""
    found = re.split(r"(?:^|, )([A-Za-z_][A-Za-z0-9_]*): ", text)
    return dict(reversed(list(zip(found[1::2], found[2::2], strict=True))))
