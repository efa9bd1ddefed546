"""Small helpers of the operators: table reading, written cuts, crc folds, pair components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.session import scratch_path


def tidied(run):
    """A map over Arrow batches that gives its memory back to the system when its task ends: idle Python workers would keep it
    while other stages run."""

    def map_batches(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return map_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str) -> Column:
    """Whole text; null counts as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Connected components of an edge list, as rows (node, root) with the smallest node as root.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): every round is one
    aggregate and one join over the edges, whose count never grows; neighbours of a node are
    never gathered.  Each round is written to the shared folder.  Nodes without an edge to
    another node are not returned.  Empty input gives an empty table.
    """
    cur = written(
        edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    seen = mark(cur)
    while seen[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        cur = written(small.filter("u <> v").distinct(), "edges")
        now = mark(cur)
        if now == seen:
            break
        seen = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
