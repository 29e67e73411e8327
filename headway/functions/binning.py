"""Equal-width edges and the three ways values are put into bins.

``lo`` and ``hi`` may be columns or plain numbers, so the same expressions serve
edges that differ by row and edges fitted beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def edges(lo, hi, k: int) -> list[Column]:
    """k evenly spaced points; the last is ``hi`` itself."""
    lo, hi = _column(lo), _column(hi)
    step = (hi - lo) / F.lit(float(k - 1))
    return [lo + F.lit(float(i)) * step for i in range(k - 1)] + [hi]


def linspace(lo, hi, k: int) -> Column:
    return F.array(*edges(lo, hi, k))


def digitize(x: Column, points: Sequence[Column]) -> Column:
    """Number of edges at or below ``x``: 0 under the range, all of them at or over its end."""
    reached = [F.when(x >= point, 1).otherwise(0) for point in points]
    return F.when(x.isNotNull() & points[0].isNotNull(), reduce(add, reached))


def cut(x: Column, points: Sequence[Column]) -> Column:
    """Right-closed bins from 1, the lowest edge included; null outside."""
    chain = F.when(x < points[0], F.lit(None).cast("int"))
    for i, point in enumerate(points[1:], start=1):
        chain = chain.when(x <= point, i)
    return F.when(points[0] < points[-1], chain)


def edge_label(lo: Column, hi: Column, separator: str = "-") -> Column:
    """``"lo-hi"`` with two decimals."""
    return F.concat_ws(separator, F.format_string("%.2f", lo), F.format_string("%.2f", hi))


def histogram_bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Bin 0..bins-1 of equal width, the last closed on the right.

    A value is settled against the computed edges, so rounding in the division
    cannot move it over an edge. With a single value, the range is widened by a
    half to both sides.
    """
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = F.lit((hi - lo) / bins)
    guess = F.floor((x - F.lit(lo)) * F.lit(bins / (hi - lo)))
    guess = F.least(F.greatest(guess, F.lit(0)), F.lit(bins - 1))
    settled = (
        F.when(x < F.lit(lo) + guess * step, guess - 1)
        .when((guess < bins - 1) & (x >= F.lit(lo) + (guess + 1) * step), guess + 1)
        .otherwise(guess)
    )
    return F.when(x.isNotNull(), settled)
