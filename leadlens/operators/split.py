"""Exact, reproducible stratified split and folds.

Every row gets its rank inside its class in a seeded hash order
(``md5(key || '-' || seed)``, key breaks hash ties).  A window partitioned by
class alone would put a whole class (half the table) into one task, so the
rank is computed in two levels: rows are counted per (class, hash bucket) —
the bucket is the first hex digits of the same md5, hence uniform and
order-consistent — a window over that small table gives each bucket's
offset, and a window per (class, bucket) numbers the rows inside it.
The result does not depend on partitioning, and sizes per class are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.functions.columns import quoted

SEED = 42
SPLIT_FRACTIONS = (0.70, 0.15, 0.15)
N_FOLDS = 5
PREFIX = 4  # hex digits of a hash bucket: 65,536 buckets a class, of 15 million rows each at 10^12 rows


def hash_order(key: str | Sequence[str], seed: int = SEED) -> Column:
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws("-", *[quoted(k).cast("string") for k in keys], F.lit(str(seed))))


def class_rank(df: DataFrame, key: str | Sequence[str], target: str = "y", seed: int = SEED, prefix: int = PREFIX) -> DataFrame:
    """Adds ``_h`` (hash), ``class_rank`` (1-based rank in class by hash order) and ``class_n``; any ``prefix`` gives the same ranks.

    The input is dealt once, by (class, bucket): the buckets' offsets meet it there, and there it is ranked."""
    t = quoted(target)
    # rows without a target are a class of their own
    own = {"_cn": t.isNull(), "_cv": F.coalesce(t.cast("string"), F.lit(""))}
    h = df.withColumn("_h", hash_order(key, seed)).withColumns({**own, "_b": F.substring("_h", 1, prefix)})
    place = ["_cn", "_cv", "_b"]
    counts = h.groupBy(*place).agg(F.count(F.lit(1)).alias("_bn"))
    before = Window.partitionBy("_cn", "_cv").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *place,
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"),
        F.sum("_bn").over(Window.partitionBy("_cn", "_cv")).alias("class_n"),
    )
    keys = [key] if isinstance(key, str) else list(key)
    inside = Window.partitionBy(*place).orderBy("_h", *[quoted(k) for k in keys])
    return h.join(offsets, place).withColumn("class_rank", F.col("_off") + F.row_number().over(inside)).drop(*place, "_off")


def stratified_split(
    df: DataFrame,
    key: str,
    target: str = "y",
    fractions: Sequence[float] = SPLIT_FRACTIONS,
    seed: int = SEED,
    names: Sequence[str] = ("train", "val", "test"),
) -> DataFrame:
    """Adds ``split``: the first round(n_c*f1) rows of each class in hash order
    are train, up to round(n_c*(f1+f2)) val, the rest test."""
    r = class_rank(df, key, target, seed)
    cum = 0.0
    expr = None
    for name, f in zip(names[:-1], fractions[:-1]):
        cum += f
        cond = F.col("class_rank") <= F.round(F.col("class_n") * F.lit(cum))
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    expr = expr.otherwise(names[-1]) if expr is not None else F.lit(names[-1])
    return r.withColumn("split", expr).drop("_h", "class_rank", "class_n")


def stratified_kfold(df: DataFrame, key: str, target: str = "y", k: int = N_FOLDS, seed: int = SEED) -> DataFrame:
    """Adds ``fold`` in 0..k-1: rank-in-class modulo k, so each fold keeps the class ratio."""
    r = class_rank(df, key, target, seed)
    return r.withColumn("fold", ((F.col("class_rank") - 1) % k).cast("int")).drop("_h", "class_rank", "class_n")


def take_split(df: DataFrame, *names: str) -> DataFrame:
    return df.where(F.col("split").isin(*names))


def union_splits(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def split_summary(df: DataFrame, target: str = "y", split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"), F.avg(quoted(target).cast("double")).alias("positive_rate"))
