"""Exact order statistics by bracket.

A sketch names two values that enclose every wanted rank; counting the rows below and inside says whether they do; only the rows
inside (a few in ``ACCURACY``) are then counted by value and ranked.  A bracket that misses its rank is moved to the side that holds
it, one that still holds more than ``MOST_INSIDE`` rows is sketched again from its own rows.  Each pass is one aggregate over all
columns; no pass shuffles the values outside of the brackets.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.functions.columns import quoted

#: The sketch's error is one in this many of the rows it has seen.
ACCURACY = 10_000
#: Rows that one task ranks.
MOST_INSIDE = 1_000_000


def number(col: str) -> Column:
    """The column as double; NaN counts as missing."""
    x = quoted(col).cast("double")
    return F.when(~F.isnan(x), x)


@dataclass
class _Bracket:
    column: str
    rank: int  # 0-based among the column's values
    lo: float = -math.inf
    hi: float = math.inf
    below: int = 0  # values under lo
    inside: int = 0  # values in [lo, hi]
    value: float | None = None

    def within(self, x: Column) -> Column:
        return (x >= F.lit(self.lo)) & (x <= F.lit(self.hi))


def _probes(rank: int, n: int) -> tuple[float | None, float | None]:
    """Shares of ``n`` sorted values between which ``rank`` must lie, whatever the sketch's error; None: no bound on that side."""
    slack = 2.0 / ACCURACY
    lo, hi = rank / n - slack, (rank + 1) / n + slack
    return (lo if lo > 0 else None), (hi if hi < 1 else None)


def _sketch(df: DataFrame, todo: list[_Bracket]) -> None:
    """New bounds of the brackets from a sketch of what is inside of them now, one aggregate."""
    aggs, asked = [], []
    for i, b in enumerate(todo):
        probes = _probes(b.rank - b.below, b.inside)
        shares = [p for p in probes if p is not None]
        if shares:
            x = number(b.column)
            aggs.append(F.percentile_approx(F.when(b.within(x), x), shares, ACCURACY).alias(f"q{i}"))
            asked.append((i, b, probes))
    if not aggs:
        return
    row = df.agg(*aggs).first()
    for i, b, (lo, hi) in asked:
        found = list(row[f"q{i}"])
        if lo is not None:
            b.lo = found.pop(0)
        if hi is not None:
            b.hi = found.pop(0)


def _count(df: DataFrame, todo: list[_Bracket]) -> None:
    """Counts below and inside; a bracket that misses its rank is moved to the side where it is."""
    aggs = []
    for i, b in enumerate(todo):
        x = number(b.column)
        aggs += [F.count(F.when(x < F.lit(b.lo), 1)).alias(f"b{i}"), F.count(F.when(b.within(x), 1)).alias(f"i{i}"), F.count(x).alias(f"n{i}")]
    row = df.agg(*aggs).first()
    for i, b in enumerate(todo):
        b.below, b.inside = row[f"b{i}"], row[f"i{i}"]
        if b.rank < b.below:
            b.hi, b.lo, b.below, b.inside = math.nextafter(b.lo, -math.inf), -math.inf, 0, b.below
        elif b.rank >= b.below + b.inside:
            above = b.below + b.inside
            b.lo, b.hi, b.below, b.inside = math.nextafter(b.hi, math.inf), math.inf, above, row[f"n{i}"] - above
        elif b.lo == b.hi:
            b.value = b.lo


def _rank_inside(df: DataFrame, todo: list[_Bracket]) -> None:
    """Values of the brackets from their own rows: counted by value, ranked per bracket."""
    any_inside = F.lit(False)
    for b in todo:
        any_inside = any_inside | F.coalesce(b.within(number(b.column)), F.lit(False))
    members = F.array(*[F.when(b.within(number(b.column)), F.struct(F.lit(i).alias("i"), number(b.column).alias("v"))) for i, b in enumerate(todo)])
    counts = df.where(any_inside).select(F.explode(F.array_compact(members)).alias("m")).groupBy("m.i", "m.v").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    wanted = F.element_at(F.array(*[F.lit(b.rank - b.below) for b in todo]), F.col("i") + 1)
    hits = counts.withColumn("upto", upto).where((F.col("upto") > wanted) & (F.col("upto") - F.col("n") <= wanted)).select("i", "v")
    for r in hits.collect():  # one row per bracket
        todo[r["i"]].value = r["v"]


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]], counts: Mapping[str, int]) -> dict[tuple[str, int], float]:
    """The values of the 0-based ``ranks`` per column, whose numbers of values (NULL and NaN left out) are ``counts``."""
    brackets = [_Bracket(c, int(r), inside=int(counts[c])) for c, rs in ranks.items() for r in sorted(set(rs))]
    _sketch(df, brackets)
    while True:
        todo = [b for b in brackets if b.value is None]
        if not todo:
            return {(b.column, b.rank): b.value for b in brackets}
        before = [(b.lo, b.hi, b.inside) for b in todo]
        _count(df, todo)
        # a bracket that another sketch hardly narrows holds few values, however many rows
        small = [
            b
            for b, (lo, hi, n) in zip(todo, before)
            if b.value is None and (b.lo, b.hi) == (lo, hi) and (b.inside <= MOST_INSIDE or 2 * b.inside > n)
        ]
        if small:
            _rank_inside(df, small)
        large = [b for b in todo if b.value is None]
        if large:
            _sketch(df, large)


def exact_quantiles_map(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], float]:
    """{(column, prob): value}, interpolated linearly between neighbouring order statistics (h = (n - 1) * prob) as pandas does.

    NULL and NaN are left out; a column without values is not in the result.  #columns x #probs numbers reach the driver.
    """
    cols = list(dict.fromkeys(columns))
    if not cols:
        return {}
    row = df.agg(*[F.count(number(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    counts = {c: row[f"n{i}"] for i, c in enumerate(cols) if row[f"n{i}"]}
    ranks: dict[str, list[int]] = {}
    for c, n in counts.items():
        for q in probs:
            k = math.floor((n - 1) * float(q))
            ranks.setdefault(c, []).extend({k, min(k + 1, n - 1)})
    values = order_statistics(df, ranks, counts) if ranks else {}
    out = {}
    for c, n in counts.items():
        for q in probs:
            h = (n - 1) * float(q)
            k = math.floor(h)
            lo, hi = values[(c, k)], values[(c, min(k + 1, n - 1))]
            out[(c, float(q))] = lo + (h - k) * (hi - lo) if hi != lo else lo
    return out
