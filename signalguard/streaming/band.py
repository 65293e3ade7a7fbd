"""The forecast band as a keyed streaming operator."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from signalguard.operators.detect import BandConfig, span_hours
from signalguard.streaming.prefix import Moments, band, merge, prefixes, suffixes

#: Rows judged together; the output of so many rows is held, never that of a whole backlog.
CHUNK = 4096
#: Tail states kept under one entry of the state store.
PLACES = 64
#: Groups that keys are dealt into; fixed for the life of a checkpoint.
GROUPS = 1024

# Numbers are kept as bytes of doubles; those of ``x`` only where the model looks at them.
_HEAD = "row bigint, at bigint, last binary, moments binary, timer bigint"
_POINTS = "x binary, y binary"


def _numbers(data: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(data).reshape(shape)


class BandProcessor:
    """Keeps the history of one key's signals and judges its rows in time order.

    With a cap of N rows the state is the running block of at most N rows and, for the
    block before it, the moments of each of its tails.  A row costs one merge; a full pass
    over the block happens once per N rows.

    After a silence of more than ``retire`` hours a key starts anew.  Its rows decide that, so
    the result does not depend on how the rows came in batches; a timer only frees the
    state of keys that stay silent.
    """

    def __init__(
        self,
        config: BandConfig,
        key_names: Sequence[str],
        signals: Sequence[str],
        only_anomalies: bool,
        retire: float | None = None,
    ):
        self.config = config
        self.key_names = list(key_names)
        self.signals = np.array(signals, dtype=object)
        self.only_anomalies = only_anomalies
        self.retire = None if retire is None else round(retire * 3.6e9)

    # --- state -------------------------------------------------------------------------

    def init(self, handle: StatefulProcessorHandle | _KeyHandle) -> None:
        self.handle = handle
        self.head_state = handle.getValueState("head", _HEAD)
        if self.config.max_training is not None:
            self.point_state = handle.getListState("points", _POINTS)
            self.tail_state = handle.getMapState("tails", "place int", "moments binary")

    def _start(self) -> None:
        """No history: the key is new, or was silent for too long."""
        width = len(self.signals)
        self.row, self.at, self.last = 0, None, np.full(width, np.nan)
        self.head = Moments.none(width)
        self.fresh: list[tuple[np.ndarray, np.ndarray]] = []  # points not yet stored
        self.tails: Moments | None = None  # of a block that ended in this call
        self.anew = True  # whether stored points and tails are void

    def _load(self) -> None:
        self._start()
        self.anew, self.timer = False, 0
        self.stored = self.head_state.exists()
        if self.stored:
            self.row, self.at, last, numbers, self.timer = self.head_state.get()
            self.last = _numbers(last, -1)
            self.head = Moments.from_flat(_numbers(numbers, -1, 6))

    def _save(self) -> None:
        if self.retire is not None and not self.timer and self.at is not None:
            self.timer = self.due(self.at)
            self.handle.registerTimer(self.timer)
        self.head_state.update(
            (self.row, self.at, self.last.tobytes(), self.head.flat().tobytes(), self.timer)
        )
        cap = self.config.max_training
        if cap is None:
            return
        if self.anew:
            self.point_state.clear()
            self.tail_state.clear()
        if self.tails is not None:
            numbers = self.tails.flat()
            # Only the places of rows still to come are read again.
            for part in range((self.row % cap or cap) // PLACES, -(-cap // PLACES)):
                some = numbers[part * PLACES : (part + 1) * PLACES]
                self.tail_state.updateValue((part,), (some.tobytes(),))
        if self.fresh:
            paired = self.config.paired
            self.point_state.appendList(
                [(xs.tobytes() if paired else b"", ys.tobytes()) for xs, ys in self.fresh]
            )

    def due(self, at: int) -> int:
        """When a key whose newest row is of ``at`` may be forgotten, in milliseconds."""
        return (at + self.retire) // 1000 + 1

    def forget(self) -> None:
        self.head_state.clear()
        if self.config.max_training is not None:
            self.point_state.clear()
            self.tail_state.clear()

    def _end_block(self) -> None:
        """The running block is full: its tails serve the next one."""
        width = len(self.signals)
        stored = [] if self.anew else list(self.point_state.get())
        points = []
        for xs, ys in stored:
            ys = _numbers(ys, -1, width)
            points.append((_numbers(xs, -1, width) if xs else np.zeros(ys.shape), ys))
        points += self.fresh
        self.tails = suffixes(*[np.concatenate(part) for part in zip(*points, strict=True)])
        self.head, self.fresh, self.anew = Moments.none(width), [], True

    def _tails(self, first: int, last: int) -> Moments:
        """The tail states of places ``first`` to ``last`` of the block before."""
        if self.tails is not None:
            return self.tails.rows(slice(first, last))
        parts = range(first // PLACES, (last - 1) // PLACES + 1)
        found = [self.tail_state.getValue((part,))[0] for part in parts]
        flat = np.concatenate([_numbers(f, -1, len(self.signals), 6) for f in found])
        skipped = parts[0] * PLACES
        return Moments.from_flat(flat).rows(slice(first - skipped, last - skipped))

    # --- rows --------------------------------------------------------------------------

    def take_over(self, seed) -> None:
        """Start from what ``band_seed`` found in the stored history of the key."""
        width, cap = len(self.signals), self.config.max_training
        self._start()
        self.timer = 0
        self.row, self.at = int(seed.rows), int(seed.micros)
        self.last = np.array(seed.last, dtype=float)
        if cap is None:
            self.head = Moments.from_flat(np.array(seed.moments, dtype=float).reshape(width, 6))
        else:
            xs = np.array(seed.xs, dtype=float).reshape(-1, width)
            ys = np.array(seed.ys, dtype=float).reshape(-1, width)
            here = self.row - (self.row - 1) // cap * cap  # rows of the running block
            if len(ys) > here:
                self.tails = suffixes(xs[:-here], ys[:-here])
            self.fresh = [(xs[-here:], ys[-here:])]
            self.head = prefixes(xs[-here:], ys[-here:]).rows(-1)
        self._save()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        whole = pd.concat(list(rows), ignore_index=True)
        micros, hours, ats, ys = arrays(whole, len(self.signals))
        order = np.argsort(micros, kind="stable")
        names = dict(zip(self.key_names, key, strict=True))
        for found in self.judge(micros[order], hours[order], ats[order], ys[order]):
            yield pd.DataFrame(names | found)

    def judge(self, micros, hours, ats, ys, watermark: int | None = None) -> Iterator[dict]:
        """Judge the key's rows, in time order, and keep what its next rows need."""
        self._load()
        cap, n = self.config.max_training, len(micros)
        gaps = np.zeros(n, bool)
        if self.retire is not None:
            gaps[1:] = np.diff(micros) > self.retire
            gaps[0] = self.at is not None and micros[0] - self.at > self.retire
        starts = [*np.flatnonzero(gaps).tolist(), n]
        i = 0
        while i < n:
            if gaps[i]:
                self._start()
                starts = starts[1:]
            until = min(i + CHUNK, starts[0])
            if cap is not None:
                if self.row and self.row % cap == 0:
                    self._end_block()
                until = min(until, i + cap - self.row % cap)
            found = self._judge(hours[i:until], ats[i:until], ys[i:until])
            self.row, self.at = self.row + until - i, int(micros[until - 1])
            i = until
            if found is not None:
                yield found
        if self.retire is not None and watermark is not None and self.due(self.at) <= watermark:
            # Rows still to come are behind the watermark, so they start anew.
            if self.stored:
                self.forget()
        else:
            self._save()

    def _judge(self, hours, ats, ys) -> dict | None:
        """Judge consecutive rows of one block and add them to the history."""
        config = self.config
        if config.model == "ar1":
            xs = np.concatenate([self.last[None], ys[:-1]])
        else:
            xs = np.repeat(hours[:, None], ys.shape[1], axis=1)
        upto = prefixes(xs, ys)
        before = Moments(*[np.concatenate([np.zeros((1, ys.shape[1])), p[:-1]]) for p in upto])
        before = merge(self.head, before)
        if config.max_training is not None:
            if self.row >= config.max_training:
                place = self.row % config.max_training
                before = merge(self._tails(place, place + len(ys)), before)
            self.fresh.append((xs, ys))
        forecast, upper, lower = band(before, xs, config.model, config.min_training, config.z)
        odd = (ys > upper) | (ys < lower)  # a comparison with NaN is false
        self.head, self.last = merge(self.head, upto.rows(-1)), ys[-1]
        if self.only_anomalies and not odd.any():
            return None
        row, signal = np.nonzero(odd if self.only_anomalies else np.ones_like(odd))
        return {
            "name": self.signals[signal],
            "ts": ats[row],
            "value": ys[row, signal],
            "forecast_value": forecast[row, signal],
            "upper_bound": upper[row, signal],
            "lower_bound": lower[row, signal],
            "is_anomaly": odd[row, signal],
            "training_size": before.n[row, signal].astype(np.int64),
        }


def arrays(rows: pd.DataFrame, width: int) -> tuple[np.ndarray, ...]:
    """Time in microseconds and in hours, time as given, and the values of rows."""
    return (
        rows["micros"].to_numpy(),
        rows["hours"].to_numpy(dtype=float),
        rows["at"].to_numpy(),
        rows[[f"y{i}" for i in range(width)]].to_numpy(dtype=float),
    )


# --- many keys to a call ---------------------------------------------------------------


class _KeyHandle:
    """The state of one key at a time, kept as entries of its group's maps."""

    def __init__(self, handle: StatefulProcessorHandle, ids: Sequence[str]):
        self.handle = handle
        self.schema = ", ".join(f"{name} string" for name in ids)
        self.key: tuple = ()
        self.bare = False  # no key of the group has state
        self.due: int | None = None

    def getValueState(self, name: str, schema: str) -> _KeyValue:
        return _KeyValue(self, name, schema)

    def getListState(self, name: str, schema: str) -> _KeyParts:
        return _KeyParts(self, name, schema)

    def getMapState(self, name: str, _: str, schema: str) -> _KeyParts:
        return _KeyParts(self, name, schema)

    def registerTimer(self, due: int) -> None:
        self.due = due if self.due is None else min(self.due, due)


class _KeyValue:
    """A value of the current key."""

    def __init__(self, at: _KeyHandle, name: str, schema: str):
        self.at, self.found = at, None
        self.entries = at.handle.getMapState(name, at.schema, schema)

    def exists(self) -> bool:
        self.found = None if self.at.bare else self.entries.getValue(self.at.key)
        return self.found is not None

    def get(self) -> tuple:
        return self.found

    def update(self, value: tuple) -> None:
        self.entries.updateValue(self.at.key, value)

    def clear(self) -> None:
        self.entries.removeKey(self.at.key)


class _KeyParts:
    """Numbered parts of the current key, as a list or by number; how many is kept with them."""

    def __init__(self, at: _KeyHandle, name: str, schema: str):
        self.at = at
        self.parts = at.handle.getMapState(name, f"{at.schema}, part int", schema)
        self.sizes = at.handle.getMapState(f"{name}_size", at.schema, "size int")

    def _size(self) -> int:
        found = None if self.at.bare else self.sizes.getValue(self.at.key)
        return found[0] if found else 0

    def get(self) -> Iterator[tuple]:
        return (self.getValue((part,)) for part in range(self._size()))

    def appendList(self, values: Sequence[tuple]) -> None:
        size = self._size()
        for part, value in enumerate(values, size):
            self.parts.updateValue((*self.at.key, part), value)
        self.sizes.updateValue(self.at.key, (size + len(values),))

    def getValue(self, part: tuple) -> tuple:
        return self.parts.getValue((*self.at.key, *part))

    def updateValue(self, part: tuple, value: tuple) -> None:
        self.parts.updateValue((*self.at.key, *part), value)
        if part[0] >= self._size():
            self.sizes.updateValue(self.at.key, (part[0] + 1,))

    def clear(self) -> None:
        for part in range(self._size()):
            self.parts.removeKey((*self.at.key, part))
        self.sizes.removeKey(self.at.key)


class GroupProcessor(StatefulProcessor):
    """Judges all keys of a group in one call, each by a ``BandProcessor``.

    A call, a frame in and a frame out cost many times what judging the rows of a key that
    has few does, and a timer of every key costs as much again.  A group has one timer, and
    state is read and written for those keys only that have rows.
    """

    def __init__(self, one: BandProcessor):
        self.one = one
        self.ids = [f"key{i}" for i in range(len(one.key_names))]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.keys = handle, _KeyHandle(handle, self.ids)
        self.one.init(self.keys)
        if self.one.retire is not None:
            self.timer_state = handle.getValueState("timer", "due bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        # A group's state may come in several frames, but a key's is in one row.
        self.keys.bare, self.keys.due = True, None
        ids = self._ids(initialState)
        for i, seed in enumerate(initialState.itertuples(index=False)):
            self.keys.key = tuple(column[i] for column in ids)
            self.one.take_over(seed)
        self._watch()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        whole = pd.concat(list(rows), ignore_index=True)
        micros, hours, ats, ys = arrays(whole, len(self.one.signals))
        numbers = whole.groupby(self.ids, sort=False, dropna=False).ngroup().to_numpy()
        order = np.lexsort((micros, numbers))
        micros, hours, ats, ys = micros[order], hours[order], ats[order], ys[order]
        firsts = np.flatnonzero(np.diff(numbers[order], prepend=-1))
        ids = self._ids(whole)
        self.keys.bare, self.keys.due = not self.one.head_state.entries.exists(), None
        watermark = timerValues.getCurrentWatermarkInMs()
        found, size = [], 0
        for first, until in zip(firsts, [*firsts[1:], len(order)], strict=True):
            self.keys.key = tuple(column[order[first]] for column in ids)
            part = slice(first, until)
            for part in self.one.judge(micros[part], hours[part], ats[part], ys[part], watermark):
                found.append((order[first], part))
                size += len(part["ts"])
                if size >= CHUNK:
                    yield self._frame(whole, found)
                    found, size = [], 0
        if found:
            yield self._frame(whole, found)
        self._watch()

    def _ids(self, rows: pd.DataFrame) -> list[np.ndarray]:
        """The keys as text, by which their state is kept."""
        texts = rows[self.ids].astype(object)
        return [column.to_numpy() for _, column in texts.where(texts.notna(), None).items()]

    def _frame(self, whole: pd.DataFrame, found: list[tuple[int, dict]]) -> pd.DataFrame:
        """What was found, with the keys of the rows given with it."""
        rows = np.repeat([row for row, _ in found], [len(part["ts"]) for _, part in found])
        names = {name: whole[name].take(rows).to_numpy() for name in self.one.key_names}
        return pd.DataFrame(
            names | {c: np.concatenate([part[c] for _, part in found]) for c in found[0][1]}
        )

    def _watch(self) -> None:
        """A group with state has a timer."""
        if self.keys.due is not None and not self.timer_state.exists():
            self._wait_until(self.keys.due)

    def _wait_until(self, due: int) -> None:
        self.handle.registerTimer(due)
        self.timer_state.update((due,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Forget the keys that are silent, and look again when others may be."""
        now, left = timerValues.getCurrentWatermarkInMs(), []
        self.keys.bare = False
        for ids, head in list(self.one.head_state.entries.iterator()):
            due = self.one.due(head[1])
            if due > now:
                left.append(due)
            else:
                self.keys.key = tuple(ids)
                self.one.forget()
        if left:
            # All keys are looked at, so not for each one that falls silent.
            self._wait_until(max(min(left), now + self.one.retire // 8000))
        else:
            self.timer_state.clear()
        return iter([])

    def close(self) -> None:
        pass


_OUT = (
    T.StructType()
    .add("name", T.StringType())
    .add("ts", T.TimestampType())
    .add("value", T.DoubleType())
    .add("forecast_value", T.DoubleType())
    .add("upper_bound", T.DoubleType())
    .add("lower_bound", T.DoubleType())
    .add("is_anomaly", T.BooleanType())
    .add("training_size", T.LongType())
)


def _rows(
    df: DataFrame, keys: Sequence[str], ts: str, names: Sequence[str], config: BandConfig
) -> DataFrame:
    """Keys, time and values under the names the processor reads."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    origin = F.unix_micros(F.lit(config.time_origin).cast("timestamp"))
    # The worker renames columns that start with an underscore.
    return df.select(
        *keys,
        F.col(ts).alias("at"),
        micros.alias("micros"),
        ((micros - origin).cast("double") / F.lit(3.6e9)).alias("hours"),
        *[F.col(name).cast("double").alias(f"y{i}") for i, name in enumerate(names)],
    )


def _grouped(df: DataFrame, keys: Sequence[str], groups: int) -> GroupedData:
    """The rows by groups of keys; the keys as text beside them."""
    texts = {f"key{i}": F.col(key).cast("string") for i, key in enumerate(keys)}
    number = F.pmod(F.xxhash64(*keys), F.lit(groups))
    return df.withColumns({"key_group": number, **texts}).groupBy("key_group")


def stream_band(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    values: str | Sequence[str],
    config: BandConfig = BandConfig(),
    out: str = "r",
    only_anomalies: bool = False,
    retire: str | None = None,
    seed: DataFrame | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """``detect_anomalies`` on a stream of windowed rows.

    ``values`` is one column (long rows: the keys name the series; the column keeps its
    name) or several (wide rows: each signal is a series of the key; they come out as
    columns ``signal`` and ``observed_value``).  Wide rows cost one state access for all
    signals of a key.  ``only_anomalies`` drops the other rows before they leave the
    Python worker.

    ``retire``, such as ``"7 days"``: a key that was silent for longer starts anew, and the
    state of keys that stay silent goes away.  ``seed``, from ``band_seed``: the history of
    each key before the stream's first row, so that a live job need not replay it.

    Put it after ``tumble``: windows close in event-time order, so the rows of a key
    arrive in order, at most one per window.  The keys are dealt into ``groups``, a number fixed
    for the life of a checkpoint: the rows of a group in one micro-batch are held as arrays, so
    more groups hold less, and fewer take less time; the source's files per trigger bound them
    too.  The time column
    stays usable for a further window.  Keys must not be NULL.  Needs the RocksDB state
    store.
    """
    wide = not isinstance(values, str)
    names = list(values) if wide else [values]
    hours = None if retire is None else span_hours(retire)
    one = BandProcessor(config, keys, names, only_anomalies, hours)
    judged = _grouped(
        _rows(df, keys, ts, names, config), keys, groups
    ).transformWithStateInPandas(
        statefulProcessor=GroupProcessor(one),
        outputStructType=T.StructType(df.select(*keys).schema.fields + _OUT.fields),
        outputMode="Append",
        timeMode="EventTime",
        initialState=None if seed is None else _grouped(seed, keys, groups),
        eventTimeColumnName="ts",
    )
    return judged.select(
        *keys,
        *([F.col("name").alias("signal")] if wide else []),
        F.col("ts").alias(ts),
        F.col("value").alias("observed_value" if wide else values),
        F.struct(
            "forecast_value", "upper_bound", "lower_bound", "is_anomaly", "training_size"
        ).alias(out),
    )


def band_seed(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    values: str | Sequence[str],
    config: BandConfig = BandConfig(),
    retire: str | None = None,
) -> DataFrame:
    """The state of every key after its stored windowed rows, one row per key.

    The same columns and settings as for the ``stream_band`` it seeds.  Without a cap the
    moments are aggregated; with a cap of N rows the last block and the one before it
    travel, at most 2 N rows of a key.  With ``retire`` only rows after a key's last long
    silence count.
    """
    names = [values] if isinstance(values, str) else list(values)
    rows = _rows(df, keys, ts, names, config).where(F.col("micros").isNotNull())
    whole = Window.partitionBy(*keys).orderBy("micros")
    cells = range(len(names))
    rows = rows.withColumns({f"y{i}": F.nanvl(f"y{i}", F.lit(None).cast("double")) for i in cells})
    if retire is not None:
        gap = F.col("micros") - F.lag("micros").over(whole) > round(span_hours(retire) * 3.6e9)
        anew = F.max(F.when(gap, F.col("micros"))).over(Window.partitionBy(*keys))
        rows = rows.withColumn("anew", anew).where("anew IS NULL OR micros >= anew")
    x = {i: F.col("hours") for i in cells}
    if config.model == "ar1":
        rows = rows.withColumns({f"x{i}": F.lag(f"y{i}").over(whole) for i in cells})
        x = {i: F.col(f"x{i}") for i in cells}
    numbers = lambda columns: F.array(
        *[F.coalesce(c, F.lit(float("nan"))) for c in columns]
    )
    state = [
        F.count(F.lit(1)).alias("rows"),
        F.max("micros").alias("micros"),
        F.max_by(numbers([F.col(f"y{i}") for i in cells]), "micros").alias("last"),
    ]
    if config.max_training is None:
        pairs = [
            (
                F.regr_count(y, x[i]).cast("double"),
                F.regr_avgx(y, x[i]),
                F.regr_avgy(y, x[i]),
                F.regr_sxx(y, x[i]),
                F.regr_syy(y, x[i]),
                F.regr_sxy(y, x[i]),
            )
            for i in cells
            for y in [F.col(f"y{i}")]
        ]
        flat = F.array(*[F.coalesce(c, F.lit(0.0)) for signal in pairs for c in signal])
        return rows.groupBy(*keys).agg(*state, flat.alias("moments"))
    cap = config.max_training
    total = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    rows = rows.withColumns({"place": F.row_number().over(whole) - 1, "total": total})
    point = F.struct(
        "place",
        numbers([x[i] for i in cells]).alias("x"),
        numbers([F.col(f"y{i}") for i in cells]).alias("y"),
    )
    near = F.col("place") >= (F.floor((F.col("total") - 1) / cap) - 1) * cap
    points = F.sort_array(F.collect_list(F.when(near, point)))
    seeds = rows.groupBy(*keys).agg(*state, points.alias("points"))
    return seeds.select(
        *keys,
        "rows",
        "micros",
        "last",
        F.flatten(F.transform("points", lambda p: p["x"])).alias("xs"),
        F.flatten(F.transform("points", lambda p: p["y"])).alias("ys"),
    )
