"""Running moments over whole arrays: the batch operator's arithmetic, many rows at once.

A state holds per signal the count, the means and the centred sums of (x, y).  States of
disjoint rows merge without cancellation, so the state before every row of a chunk comes from
merging neighbours at distances 1, 2, 4, ... and then what was there before the chunk.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Moments(NamedTuple):
    """Arrays of one shape, the last axis being the signals."""

    n: np.ndarray
    mx: np.ndarray
    my: np.ndarray
    sxx: np.ndarray
    syy: np.ndarray
    sxy: np.ndarray

    @classmethod
    def none(cls, *shape: int) -> Moments:
        return cls(*np.zeros((6, *shape)))

    def rows(self, where) -> Moments:
        return Moments(*[part[where] for part in self])

    def flat(self) -> np.ndarray:
        """The numbers of each signal side by side; ``from_flat`` reads them back."""
        return np.stack(self, axis=-1)

    @classmethod
    def from_flat(cls, numbers: np.ndarray) -> Moments:
        return cls(*np.moveaxis(numbers, -1, 0))


def merge(a: Moments, b: Moments) -> Moments:
    """The state of the rows of both; an empty state is all zeros."""
    n = a.n + b.n
    share = np.divide(b.n, n, out=np.zeros(n.shape), where=n > 0)
    weight = a.n * share
    dx, dy = b.mx - a.mx, b.my - a.my
    return Moments(
        n,
        a.mx + dx * share,
        a.my + dy * share,
        a.sxx + b.sxx + dx * dx * weight,
        a.syy + b.syy + dy * dy * weight,
        a.sxy + b.sxy + dx * dy * weight,
    )


def prefixes(xs: np.ndarray, ys: np.ndarray) -> Moments:
    """The state of every row and all rows before it; a NaN in either is no pair."""
    valid = ~(np.isnan(xs) | np.isnan(ys))
    zeros = np.zeros(ys.shape)
    found = Moments(
        valid.astype(float),
        np.where(valid, xs, 0.0),
        np.where(valid, ys, 0.0),
        zeros,
        zeros,
        zeros,
    )
    step = 1
    while step < len(ys):
        ahead = merge(found.rows(slice(None, -step)), found.rows(slice(step, None)))
        found = Moments(
            *[np.concatenate([old[:step], new]) for old, new in zip(found, ahead, strict=True)]
        )
        step *= 2
    return found


def suffixes(xs: np.ndarray, ys: np.ndarray) -> Moments:
    """The state of every row and all rows after it."""
    return prefixes(xs[::-1], ys[::-1]).rows(slice(None, None, -1))


def band(
    m: Moments, xs: np.ndarray, model: str, min_training: int, z: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forecast, upper, lower) from the state before each row; NaN before enough training."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if model == "mean":
            forecast, spread = m.my, np.sqrt(m.syy / (m.n - 1))
        else:
            slope = m.sxy / np.where(m.sxx == 0.0, np.nan, m.sxx)
            forecast = m.my + slope * (xs - m.mx)
            spread = np.sqrt(np.maximum(m.syy - slope * m.sxy, 0.0) / (m.n - 2))
        forecast = np.where(m.n >= min_training, forecast, np.nan)
        return forecast, forecast + z * spread, forecast - z * spread
