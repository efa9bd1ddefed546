"""Encoding of columns of many levels: a level dictionary as a table, joined, with sparse rows as the result.

No level list reaches the driver or the plan, so a column may have as many levels as rows.  What reaches the driver is the number of slots per
column.  Slots: the numeric columns in their order, the ordinal one, then every nominal column's levels, in an order of their own (by hash, so that
levels are numbered without a single task).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.functions.columns import quoted
from leadlens.operators.features import EDUCATION_ORDER, fit_standard_scaler, ordinal_code, safe_name, scaled
from leadlens.operators.split import class_rank


def level_dictionary(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, level, at): the levels that get a slot, numbered from 0 within their column.

    NULL is no level.  Of exactly two levels the alphabetically second alone is kept.  Column names are compared as given.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("level")) for c in columns]))
    levels = train.select(pairs).where("level IS NOT NULL").groupBy("column", "level").agg(F.lit(1).alias("_1")).drop("_1")
    least = levels.groupBy("column").agg(F.min("level").alias("_least"), F.count(F.lit(1)).alias("_n"))  # one row per column
    kept = levels.join(F.broadcast(least), "column").where("_n <> 2 OR level <> _least").select("column", "level")
    return class_rank(kept, "level", "column").select("column", "level", (F.col("class_rank") - 1).alias("at"))


@dataclass
class SparseEncoder:
    """Fitted state: scaling numbers, the dictionary's table and where each column's slots start."""

    numeric: list[str]
    scale: dict[str, tuple[float, float]]
    ordinal: str | None
    nominal: list[str]
    dictionary: DataFrame
    start: dict[str, int]
    size: int
    order: list[str]

    def encode(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep``, ``size``, ``indices`` (ascending) and ``values`` of the non-zero slots.

        Unseen and NULL levels, and NULL numerics, have no slot set; an unseen or NULL ordinal is -1.  Each nominal column meets its levels in
        a join of its own: small dictionaries are broadcast by their measured size, large ones are shuffled.
        """
        dense = [scaled(c, *self.scale[c]) for c in self.numeric] + ([ordinal_code(self.ordinal, self.order).cast("double")] if self.ordinal else [])
        out = df.select(
            *[quoted(k).alias(f"_keep{i}") for i, k in enumerate(keep)],
            F.array(*dense).cast("array<double>").alias("_dense"),
            *[quoted(c).cast("string").alias(f"_level{i}") for i, c in enumerate(self.nominal)],
        )
        for i, c in enumerate(self.nominal):
            known = self.dictionary.where(F.col("column") == c).select(F.col("level").alias(f"_level{i}"), (F.col("at") + self.start[c]).alias(f"_slot{i}"))
            out = out.join(known, f"_level{i}", "left").drop(f"_level{i}")
        pairs = F.transform("_dense", lambda v, i: F.struct(i.cast("long").alias("i"), v.alias("v")))
        hot = F.array(*[F.struct(F.col(f"_slot{i}").cast("long").alias("i"), F.lit(1.0).alias("v")) for i in range(len(self.nominal))])
        if self.nominal:
            pairs = F.concat(pairs, hot)
        full = F.array_sort(F.filter(pairs, lambda p: p["i"].isNotNull() & p["v"].isNotNull() & (p["v"] != 0)))
        out = out.withColumn("_p", full)
        return out.select(
            *[F.col(f"_keep{i}").alias(k) for i, k in enumerate(keep)],
            F.lit(self.size).cast("long").alias("size"),
            F.transform("_p", lambda p: p["i"]).alias("indices"),
            F.transform("_p", lambda p: p["v"]).alias("values"),
        )

    def names(self) -> DataFrame:
        """(slot, feature) of every slot."""
        fixed = [safe_name(c) for c in self.numeric] + ([f"ord_{safe_name(self.ordinal)}"] if self.ordinal else [])
        spark = self.dictionary.sparkSession
        base = spark.createDataFrame(list(enumerate(fixed)), "slot long, feature string")
        starts = spark.createDataFrame([(c, safe_name(c), s) for c, s in self.start.items()], "column string, safe string, start long")
        levels = self.dictionary.join(F.broadcast(starts), "column")
        return base.unionByName(levels.select((F.col("at") + F.col("start")).alias("slot"), F.concat_ws("_", "safe", "level").alias("feature")))


def fit_sparse_encoder(
    train: DataFrame, numeric: Sequence[str], ordinal: str | None, nominal: Sequence[str], order: Sequence[str] = tuple(EDUCATION_ORDER)
) -> SparseEncoder:
    """Learns scaling and levels on the training rows; the dictionary is written, as every encoding joins it."""
    from leadlens.session import materialize

    dictionary = materialize(level_dictionary(train, nominal), "levels") if nominal else train.sparkSession.createDataFrame([], "column string, level string, at long")
    counts = {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    at, start = len(numeric) + (1 if ordinal else 0), {}
    for c in nominal:
        start[c], at = at, at + counts.get(c, 0)
    return SparseEncoder(list(numeric), fit_standard_scaler(train, numeric), ordinal, list(nominal), dictionary, start, at, list(order))


def to_vector(encoded: DataFrame, out: str = "features") -> DataFrame:
    """The sparse arrays as an ML vector (one short Python call a row: ML has no vector expression for sparse arrays)."""
    from pyspark.ml.linalg import SparseVector, VectorUDT

    make = F.udf(lambda n, i, v: SparseVector(n, i, v), VectorUDT())
    return encoded.withColumn(out, make("size", "indices", "values")).drop("size", "indices", "values")
