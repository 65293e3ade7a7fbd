"""Keys of a stream are judged in groups: same rows, few calls, frames and timers."""

import numpy as np
import pandas as pd

from signalguard.operators.detect import BandConfig
from signalguard.streaming.band import BandProcessor, GroupProcessor


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Entries(dict):
    def exists(self):
        return bool(self)

    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        self.pop(key, None)

    def iterator(self):
        return iter(self.items())


class Handle:
    def __init__(self):
        self.maps, self.value, self.timers = {}, Value(), []

    def getValueState(self, *_):
        return self.value

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, Entries())

    def registerTimer(self, at):
        self.timers.append(at)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now


def rows(keys, n, start=0, seed=1):
    rng = np.random.default_rng(seed)
    minutes = np.tile(np.arange(start, start + n), keys)
    names = np.repeat([f"u{i}" for i in range(keys)], n)
    frame = pd.DataFrame(
        {
            "key_group": 1,
            "k": names,
            "key0": names,
            "at": pd.Timestamp("2024-01-01") + pd.to_timedelta(minutes, "min"),
            "micros": minutes * 60_000_000,
            "hours": minutes / 60,
            "y0": rng.normal(10, 2, keys * n),
        }
    )
    return frame.sample(frac=1, random_state=seed)


def group(cap=None, retire=None):
    config = BandConfig(min_training=3, max_training=cap, confidence=80.0)
    processor, handle = GroupProcessor(BandProcessor(config, ["k"], ["p"], False, retire)), Handle()
    processor.init(handle)
    return processor, handle


def test_a_group_gives_the_rows_of_its_keys_in_few_frames():
    first, then = rows(300, 6), rows(300, 5, start=6, seed=2)
    for cap in (None, 4):
        processor, handle = group(cap)
        found = [list(processor.handleInputRows((1,), iter([f]), Clock(0))) for f in (first, then)]
        assert [len(frames) for frames in found] == [1, 1]
        got = pd.concat([f for frames in found for f in frames])
        alone = []
        for i in range(300):
            one, state = group(cap)
            for part in (first, then):
                mine = part[part["k"] == f"u{i}"]
                alone += one.handleInputRows((1,), iter([mine]), Clock(0))
            assert set(state.maps["head"]) == {(f"u{i}",)}
        by = ["k", "ts"]
        pd.testing.assert_frame_equal(
            got.sort_values(by, ignore_index=True),
            pd.concat(alone).sort_values(by, ignore_index=True),
        )
        assert got["is_anomaly"].any() and len(handle.maps["head"]) == 300


def test_a_group_has_one_timer_and_keeps_no_state_that_is_due():
    minute = 60_000
    processor, handle = group(cap=4, retire=1.0)
    list(processor.handleInputRows((1,), iter([rows(50, 9)]), Clock(9 * minute)))
    assert len(handle.timers) == 1 and len(handle.maps["head"]) == 50
    late = rows(3, 2, start=60)  # three keys go on, the others fall silent
    list(processor.handleInputRows((1,), iter([late]), Clock(62 * minute)))
    list(processor.handleExpiredTimer((1,), Clock(80 * minute), None))
    assert len(handle.timers) == 2 and set(handle.maps["head"]) == {("u0",), ("u1",), ("u2",)}
    assert {key[0] for key in handle.maps["points"]} <= {"u0", "u1", "u2"}
    list(processor.handleInputRows((1,), iter([rows(50, 2, start=90)]), Clock(999 * minute)))
    assert not any(handle.maps.values()) and len(handle.timers) == 2


def test_rows_without_a_key_share_a_history():
    """NULL is no number: a frame's keys would come as NaN, which equals nothing."""
    frame = rows(2, 6)
    other = frame["k"] == "u1"
    numbers = frame.assign(k=np.where(other, np.nan, 7.0), key0=frame["key0"].where(~other, None))
    processor, handle = group()
    got = pd.concat(processor.handleInputRows((1,), iter([numbers]), Clock(0)))
    for part in (got[got["k"].isna()], got[got["k"] == 7.0]):
        assert sorted(part["training_size"]) == list(range(6))
    assert set(handle.maps["head"]) == {("u0",), (None,)}
