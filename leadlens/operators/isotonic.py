"""Isotonic calibration without the driver: pool-adjacent-violators in blocks of the sorted scores.

Blocks of neighbouring scores are pooled each in a task; the pools of ``FAN`` neighbouring blocks are then pooled together, and so on to one
block per group.  Pooling neighbours first never changes the result, as a pool's rows stay one pool in the whole.  Scores are looked up by an
as-of join over score ranges, so that neither rows nor pools have to fit in one place.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlens.operators.evaluate import range_number, score_ranges

# tasks need no installed copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Blocks that are merged at once.
FAN = 16


def pooled(rows):
    """Pools [lo, hi, sum, weight] of ascending (lo, hi, sum, weight) rows: means that would fall are merged with what is before them."""
    stack: list = []
    for lo, hi, s, w in rows:
        while stack and stack[-1][2] * w >= s * stack[-1][3]:  # the mean before is no smaller
            a, _, t, v = stack.pop()
            lo, s, w = a, t + s, v + w
        stack.append([lo, hi, s, w])
    return stack


def _pool_blocks(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``pooled`` in every (by, block)."""
    keys = [*by, "block"]
    names = [*keys, "lo", "hi", "s", "w"]

    def run(batches):
        import pyarrow as pa

        now, rows, types = None, [], None

        def out(key, rows):
            cols = list(zip(*[(*key, *p) for p in pooled(rows)]))
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for b in batches:
            types = [b.column(i).type for i in range(len(names))]
            for r in zip(*(b.column(i).to_pylist() for i in range(len(names)))):
                key = r[: len(keys)]
                if key != now:
                    if rows:
                        yield out(now, rows)
                    now, rows = key, []
                rows.append(r[len(keys) :])
                if len(rows) > 100_000:  # pools so far stand for their rows
                    rows = [tuple(p) for p in pooled(rows)]
        if rows:
            yield out(now, rows)

    return df.select(names).repartition(*keys).sortWithinPartitions(*keys, "lo").mapInArrow(run, df.select(names).schema)


def isotonic_pools(df: DataFrame, x: str = "margin", y: str = "y", weight: str | None = None, by: Sequence[str] = (), n_ranges: int | None = None) -> DataFrame:
    """(by, lo, hi, value): the rising step function of least weighted squared error, one row per step, for each group.

    Rows of equal ``x`` are one point.  Rows with a null or NaN in x, y or the weight are left out, as are those of weight 0; an empty table gives no row.
    """
    by = list(by)
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.select(*by, F.col(x).cast("double").alias("lo"), F.col(y).cast("double").alias("_y"), w.alias("_w"))
    fine = [F.col(c).isNotNull() & ~F.isnan(c) for c in ("lo", "_y", "_w")]
    rows = rows.where(fine[0] & fine[1] & fine[2] & (F.col("_w") > 0))
    cuts = score_ranges(rows, "lo", n_ranges)
    points = rows.groupBy(*by, "lo").agg(F.sum(F.col("_w") * F.col("_y")).alias("s"), F.sum("_w").alias("w")).withColumn("hi", F.col("lo"))
    blocks, n = range_number(points, "lo", cuts, "block"), len(cuts) + 1
    out = _pool_blocks(blocks, by)
    while n > 1:
        n = -(-n // FAN)
        out = _pool_blocks(out.withColumn("block", F.floor(F.col("block") / FAN).cast("int")), by)
    return out.select(*by, "lo", "hi", (F.col("s") / F.col("w")).alias("value"))


def calibrated(df: DataFrame, pools: DataFrame, x: str = "margin", by: Sequence[str] = (), out: str = "probability", n_ranges: int | None = None) -> DataFrame:
    """``df`` with the step function's value at ``x``: inside a step its value, between two steps interpolated, beyond the ends the end's value.

    The steps before and after a row are found by running maxima and minima within score ranges, carried over the ranges.  Groups without a
    step, and rows with a null or NaN ``x``, get null.
    """
    by = list(by)
    cuts = score_ranges(df.select(F.col(x).cast("double").alias("x")), "x", n_ranges)
    step = F.struct("lo", "hi", "value")
    marks = pools.select(*by, F.col("lo").alias("_x"), F.lit(0).alias("_kind"), step.alias("_step"))
    rows = df.withColumns({"_x": F.when(~F.isnan(F.col(x).cast("double")), F.col(x).cast("double")), "_kind": F.lit(1), "_step": F.lit(None).cast(marks.schema["_step"].dataType)})
    both = range_number(rows.unionByName(marks, allowMissingColumns=True), "_x", cuts, "_range")
    # what follows is a running minimum from the other end: a frame that runs on to the last row is aggregated anew for every row
    inside = Window.partitionBy(*by, "_range")
    upto = inside.orderBy("_x", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    onward = inside.orderBy(F.desc("_x"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumns({"_at": F.max("_step").over(upto), "_next": F.min("_step").over(onward)})
    ends = both.where("_range IS NOT NULL").groupBy(*by, "_range").agg(F.max("_step").alias("_m"), F.min("_step").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        *[F.col(c).alias(f"_b_{c}") for c in by],
        F.col("_range").alias("_r"),
        F.max("_m").over(before).alias("_cat"),
        F.min("_n").over(after).alias("_cnext"),
    )
    same = F.col("_range") == F.col("_r")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    found = near.where("_kind = 1").join(carry, same, "left").withColumns({"_at": F.coalesce("_at", "_cat"), "_next": F.coalesce("_next", "_cnext")})
    at, nxt, v = F.col("_at"), F.col("_next"), F.col("_x")
    between = at["value"] + (nxt["value"] - at["value"]) * (v - at["hi"]) / (nxt["lo"] - at["hi"])
    value = F.when(v.isNull(), None).when(at.isNull(), nxt["value"]).when((v <= at["hi"]) | nxt.isNull(), at["value"]).otherwise(between)
    return found.select(*df.columns, value.alias(out))
