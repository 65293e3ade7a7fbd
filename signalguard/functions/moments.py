"""Mergeable first and second moments, as column expressions.

``n`` counts, ``my``/``mx`` are means, ``syy``/``sxx``/``sxy`` are centred sums.  Two states
over disjoint rows merge without cancellation, so a long history can be summed in
pieces (per time chunk or per block of rows) and the pieces put together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIR_FIELDS = ("n", "mx", "my", "sxx", "syy", "sxy")
SINGLE_FIELDS = ("n", "my", "syy")


@dataclass(frozen=True)
class Moments:
    n: Column
    my: Column
    syy: Column
    mx: Column | None = None
    sxx: Column | None = None
    sxy: Column | None = None

    @property
    def paired(self) -> bool:
        return self.mx is not None

    def columns(self, prefix: str) -> dict[str, Column]:
        """The state as flat columns, which windows and sorts move faster than a struct."""
        fields = PAIR_FIELDS if self.paired else SINGLE_FIELDS
        return {f"{prefix}_{name}": getattr(self, name) for name in fields}


def state_columns(prefix: str, paired: bool) -> list[str]:
    return [f"{prefix}_{name}" for name in (PAIR_FIELDS if paired else SINGLE_FIELDS)]


def read_moments(prefix: str, paired: bool) -> Moments:
    names = PAIR_FIELDS if paired else SINGLE_FIELDS
    return Moments(**{name: F.coalesce(F.col(f"{prefix}_{name}"), F.lit(0)) for name in names})


def aggregate(y: Column, x: Column | None, over=None) -> Moments:
    """Moments of ``y`` (or of the non-null pairs ``x, y``), grouped or over a window."""
    use = (lambda c: c.over(over)) if over is not None else (lambda c: c)
    if x is None:
        n = use(F.count(y))
        return Moments(n, use(F.avg(y)), use(F.var_pop(y)) * n)
    return Moments(
        n=use(F.regr_count(y, x)),
        my=use(F.regr_avgy(y, x)),
        syy=use(F.regr_syy(y, x)),
        mx=use(F.regr_avgx(y, x)),
        sxx=use(F.regr_sxx(y, x)),
        sxy=use(F.regr_sxy(y, x)),
    )


def merge(a: Moments, b: Moments) -> Moments:
    """State of the union of two disjoint sets of rows; an empty one is all zeros."""
    n = a.n + b.n
    share = F.try_divide(b.n.cast("double"), n.cast("double"))
    weight = a.n * share
    dy = b.my - a.my
    my = a.my + dy * share
    syy = a.syy + b.syy + dy * dy * weight
    if not a.paired:
        return Moments(n, my, syy)
    dx = b.mx - a.mx
    return Moments(
        n=n,
        my=my,
        syy=syy,
        mx=a.mx + dx * share,
        sxx=a.sxx + b.sxx + dx * dx * weight,
        sxy=a.sxy + b.sxy + dx * dy * weight,
    )


def running_total(state: str, paired: bool, whole, before) -> Moments:
    """Merge of the states with a column prefix over a window frame.

    ``whole`` orders the full partition and gives the centre, ``before`` is the frame
    that is summed.  Sums are taken about the first state's means.
    """
    s = read_moments(state, paired)
    filled = s.n > 0

    def centre(mean: Column) -> Column:
        return F.first(F.when(filled, mean), ignorenulls=True).over(whole)

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(filled, value)).over(before), F.lit(0.0))

    n = F.coalesce(F.sum(s.n).over(before), F.lit(0))
    count = F.nullif(n.cast("double"), F.lit(0.0))
    cy = centre(s.my)
    dy = s.my - cy
    ty = total(s.n * dy)
    my = cy + F.try_divide(ty, count)
    syy = total(s.syy + s.n * dy * dy) - F.try_divide(ty * ty, count)
    if not paired:
        return Moments(n, my, F.greatest(syy, F.lit(0.0)))
    cx = centre(s.mx)
    dx = s.mx - cx
    tx = total(s.n * dx)
    return Moments(
        n=n,
        my=my,
        syy=F.greatest(syy, F.lit(0.0)),
        mx=cx + F.try_divide(tx, count),
        sxx=F.greatest(
            total(s.sxx + s.n * dx * dx) - F.try_divide(tx * tx, count), F.lit(0.0)
        ),
        sxy=total(s.sxy + s.n * dx * dy) - F.try_divide(tx * ty, count),
    )
