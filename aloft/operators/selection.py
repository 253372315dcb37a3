"""Exact order statistics of several columns at once by radix selection.

Every pass counts the values of all columns by digit: one aggregate over (column, digit) with partial
aggregation, whose groups are bounded by the number of digits, never by the number of different
values.  The digit that holds the wanted place becomes the range of the next pass, narrowed to the
smallest and largest value seen in it; a range of one value is the answer.  A digit is a monotone
function of the value, so places are exact:

* the first pass takes sign and magnitude, 64 digits an octave, so it needs no range;
* a range on both sides of zero is cut into below, at and above zero;
* a range that spans more than an octave is cut by the logarithm, any other one evenly.

Nothing is sorted, written or gathered but the counts of the digits.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: digits of a pass, and digits an octave of the first one
DIGITS = 4096
OCTAVE = 64


@dataclass
class _Target:
    """A place (from 0) among a column's values; ``below`` of them are under the range low..high."""

    column: str
    place: int
    below: int = 0
    low: float = -math.inf
    high: float = math.inf

    @property
    def range(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high


def _digit(v: Column, low: float, high: float) -> Column:
    """A monotone whole number of a value in [low, high]; the ends' digits differ."""
    if math.isinf(low) and math.isinf(high):
        size = F.floor(F.least(F.log1p(F.abs(v)) * F.lit(OCTAVE / math.log(2)), F.lit(1e6)))
        return F.when(v < 0, -size).otherwise(size)
    if low < 0 < high or low == 0 or high == 0:
        return F.when(v < 0, F.lit(-1)).when(v > 0, F.lit(1)).otherwise(F.lit(0))
    near, far = (low, high) if low > 0 else (high, low)
    if math.isinf(far):  # the infinite value apart from the others
        return F.when(v == F.lit(far), F.lit(1 if far > 0 else -1)).otherwise(F.lit(0))
    if far / near > 2:
        part = (F.log(F.abs(v)) - F.log(F.lit(abs(near)))) / (F.log(F.lit(abs(far))) - F.log(F.lit(abs(near))))
        return F.floor((part if low > 0 else -part) * DIGITS)
    return F.floor((v - F.lit(low)) / (F.lit(high) - F.lit(low)) * DIGITS)


def _count(df: DataFrame, ranges: Sequence[tuple[str, float, float]]) -> dict[int, list]:
    """For each range the digits of its values in ascending order: (values, smallest, largest)."""
    parts = []
    for i, (c, low, high) in enumerate(ranges):
        v = F.col(c).cast("double")
        inside = v.isNotNull() & ~F.isnan(v)
        if not (math.isinf(low) and math.isinf(high)):
            inside &= v.between(F.lit(low), F.lit(high))
        parts.append(F.when(inside, F.struct(F.lit(i).alias("i"), _digit(v, low, high).cast("int").alias("digit"), v.alias("v"))))
    rows = df.select(F.explode(F.array(*parts)).alias("p")).where("p is not null").select("p.*")
    out: dict[int, list] = {i: [] for i in range(len(ranges))}
    found = rows.groupBy("i", "digit").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    for r in sorted(found.collect(), key=lambda r: (r["i"], r["digit"])):  # bounded by the number of digits
        out[r["i"]].append((r["n"], r["low"], r["high"]))
    return out


def _settle(targets: Sequence[_Target], digits: list) -> None:
    """Move each target into the digit that holds its place."""
    for t in targets:
        below = t.below
        for n, low, high in digits:
            if t.place < below + n:
                t.below, t.low, t.high = below, low, high
                break
            below += n


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The exact median of each column: the middle value, or halfway between the two middle ones.

    Nulls and NaN are not counted; a column without values has none.  ``df`` is evaluated once for each
    pass (one to three for ordinary data), so give a staged frame where that is expensive.
    """
    every = [(c, -math.inf, math.inf) for c in columns]
    first = _count(df, every) if columns else {}
    targets: dict[str, list[_Target]] = {}
    for i, c in enumerate(columns):
        n = sum(d[0] for d in first[i])
        targets[c] = [_Target(c, k) for k in sorted({(n - 1) // 2, n // 2})] if n else []
        _settle(targets[c], first[i])
    while True:
        ranges = list(dict.fromkeys(t.range for own in targets.values() for t in own if t.low < t.high))
        if not ranges:
            break
        found = _count(df, ranges)
        for own in targets.values():
            for t in own:
                if t.low < t.high:
                    _settle([t], found[ranges.index(t.range)])
    out: dict[str, float | None] = {}
    for c in columns:
        values = [t.low for t in targets[c]]
        if not values or values[0] == values[-1]:
            out[c] = values[0] if values else None
        else:
            out[c] = values[0] + (values[-1] - values[0]) * 0.5
    return out
