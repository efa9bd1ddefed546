"""Structured Streaming: score customer files as they arrive.

The batch upload flow (read -> conform -> score -> verdict -> sink) as a
micro-batch stream: ``readStream`` on a folder with a declared schema, the
same column expressions as the batch path (names normalised, numerics
sanitised, probability, YES/NO on the unrounded value), and a file sink whose
progress lives in a checkpoint under the shared checkpoint folder — so a
restarted or failed query resumes exactly once.  Only row-local expressions
are used, so no streaming state is kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.functions.columns import sanitised
from leadlens.operators.schema import RENAMES
from leadlens.session import scratch_path

Scorer = Callable[[DataFrame], DataFrame]


def normalised_stream(df: DataFrame) -> DataFrame:
    """Row-local part of schema conformance: names trimmed/lower-cased/aliased,
    numerics sanitised (NaN/NULL/Inf -> 0, clip +-1e9)."""
    names = [RENAMES.get(c.strip().lower(), c.strip().lower()) for c in df.columns]
    out = df.select(*[F.col(f"`{o}`").alias(n) for o, n in zip(df.columns, names)])
    nums = [f.name for f in out.schema.fields if isinstance(f.dataType, T.NumericType)]
    return out.withColumns({c: sanitised(c) for c in nums}) if nums else out


def score_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    scorer: Scorer,
    threshold: float,
    sink: str,
    fmt: str = "parquet",
    checkpoint: str | None = None,
    sanitise: bool = True,
    keep: tuple[str, ...] = (),
    available_now: bool = True,
    glob: str | None = None,
):
    """Start the scoring stream; returns the ``StreamingQuery``.

    ``scorer`` maps a frame to one with a ``probability`` column (e.g. a fitted
    ``PipelineModel`` wrapped by ``leadlens.operators.train.score``)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.format(fmt).option("header", True).load(source) if fmt == "csv" else reader.format(fmt).load(source)
    frame = normalised_stream(raw) if sanitise else raw
    scored = scorer(frame)
    p = F.col("probability").cast("double")
    out = scored.select(
        *[F.col(f"`{k}`") for k in keep],
        F.round(p, 4).alias("probability"),
        F.when(p >= F.lit(float(threshold)), "YES").otherwise("NO").alias("verdict"),
    )
    writer = (
        out.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "score-stream-ckpt"))
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def run_to_completion(query) -> None:
    """Drive an ``availableNow`` query until every file present at start is processed."""
    query.awaitTermination()
