"""Cleaning: leakage drop, de-duplication, percentile clipping, mode imputation.

Bounds and modes are learned with one distributed pass each and come back
to the driver as a handful of numbers/strings (#columns x 2), so the final
rewrite is a single narrow projection that stays in whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.functions.columns import quoted
from leadlens.operators.profile import (
    HIGH_CORRELATION,
    UNKNOWN,
    cardinality_report,
    correlation_pairs,
    level_counts,
    null_report,
    numeric_columns,
    quantile_map,
    skewness_report,
    string_columns,
)

# The reference's column roles on the bank table.
IMPUTE_MODE_COLS = ["job", "marital", "housing", "loan"]
KEEP_UNKNOWN_COLS = ["education", "default"]
OUTLIER_COLS = [
    "age",
    "campaign",
    "pdays",
    "previous",
    "emp.var.rate",
    "cons.price.idx",
    "cons.conf.idx",
    "euribor3m",
    "nr.employed",
]
LEAKAGE_COLS = ["duration"]


def drop_leakage(df: DataFrame, columns: Sequence[str] = tuple(LEAKAGE_COLS)) -> DataFrame:
    """Drop post-outcome columns; a no-op for absent ones."""
    return df.drop(*[c for c in columns if c in df.columns])


def dedup_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicates removed (NULL equals NULL); one shuffle on the row hash."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with NULL or NaN in any of ``subset``."""
    return df.dropna(subset=list(subset))


def keep_unknown(df: DataFrame, columns: Sequence[str] = tuple(KEEP_UNKNOWN_COLS)) -> DataFrame:
    """Columns whose ``unknown`` level is informative are kept as they are."""
    return df


def learn_clip_bounds(
    df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99
) -> dict[str, tuple[float, float]]:
    cols = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.NumericType)]
    if not cols:
        return {}
    q = quantile_map(df, cols, [low, high])
    return {c: (q[(c, low)], q[(c, high)]) for c in cols if (c, low) in q}


def clip_columns(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Clip to [lo, hi]; NULL and NaN stay as they are; clipped columns become double."""

    def clip(c: str, lo: float, hi: float) -> Column:
        x = quoted(c).cast("double")
        return F.when(x.isNull() | F.isnan(x), x).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))

    return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in bounds.items()})


def clip_outliers(
    df: DataFrame,
    columns: Sequence[str] = tuple(OUTLIER_COLS),
    low: float = 0.01,
    high: float = 0.99,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Clip each numeric column to its [q_low, q_high] (exact, pandas-style quantiles).
    ``fit_on`` learns the bounds on another frame (e.g. the training split)."""
    return clip_columns(df, learn_clip_bounds(fit_on if fit_on is not None else df, columns, low, high))


def learn_modes(df: DataFrame, columns: Sequence[str], token: str = UNKNOWN) -> dict[str, str]:
    """Most frequent known level per column (ties: alphabetically first)."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return {}
    lv = level_counts(df, cols).where(F.col("value").isNotNull() & (F.col("value") != token))
    best = lv.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    return {r["column"]: r["mode"] for r in best.collect()}


def impute_columns(df: DataFrame, modes: Mapping[str, str], token: str = UNKNOWN) -> DataFrame:
    return df.withColumns(
        {c: F.when(quoted(c) == token, F.lit(m)).otherwise(quoted(c)) for c, m in modes.items()}
    )


def impute_mode(
    df: DataFrame,
    columns: Sequence[str] = tuple(IMPUTE_MODE_COLS),
    token: str = UNKNOWN,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Replace ``unknown`` by the column's most common known level; a column
    with no known level is left untouched."""
    return impute_columns(df, learn_modes(fit_on if fit_on is not None else df, columns, token), token)


def clean_data(
    df: DataFrame,
    production: bool = True,
    leakage: Sequence[str] = tuple(LEAKAGE_COLS),
    outlier_cols: Sequence[str] = tuple(OUTLIER_COLS),
    impute_cols: Sequence[str] = tuple(IMPUTE_MODE_COLS),
    token: str = UNKNOWN,
    write: bool = True,
) -> DataFrame:
    """The cleaning sequence; the order is part of the semantics:
    drop leakage (production) -> de-duplicate -> clip -> impute.

    De-duplication happens before imputation, so imputation may create new
    duplicates that stay.  With ``write`` the de-duplicated frame is written to the
    shared folder, so the bound and mode passes and the final rewrite do not repeat
    the de-duplication shuffle.
    """
    return impute_columns(*_clipped(df, production, leakage, outlier_cols, impute_cols, token, write)[1:], token)


def _clipped(df, production, leakage, outlier_cols, impute_cols, token, write):
    """(de-duplicated, clipped, modes of the clipped)."""
    from leadlens.session import materialize

    out = dedup_rows(drop_leakage(df, leakage) if production else df)
    out = materialize(out, "deduplicated") if write else out
    clipped = clip_columns(out, learn_clip_bounds(out, outlier_cols))
    return out, clipped, learn_modes(clipped, impute_cols, token)


def clean_with_reports(
    df: DataFrame,
    production: bool = True,
    leakage: Sequence[str] = tuple(LEAKAGE_COLS),
    outlier_cols: Sequence[str] = tuple(OUTLIER_COLS),
    impute_cols: Sequence[str] = tuple(IMPUTE_MODE_COLS),
    token: str = UNKNOWN,
    numeric: Sequence[str] | None = None,
    correlation_above: float = HIGH_CORRELATION,
) -> tuple[DataFrame, DataFrame]:
    """``clean_data`` and what its steps report, as rows (report, column, value): missing values per column of the raw rows, levels per category
    after de-duplication, skewness per numeric column and strongly correlated pairs (``a~b``) after clipping."""
    raw = null_report(df).select(F.lit("missing").alias("report"), "column", F.col("null_count").cast("double").alias("value"))
    distinct, clipped, modes = _clipped(df, production, leakage, outlier_cols, impute_cols, token, True)
    levels = cardinality_report(distinct, string_columns(distinct)).select(F.lit("levels").alias("report"), "column", F.col("n_levels").cast("double").alias("value"))
    nums = list(numeric or numeric_columns(clipped))
    skew = skewness_report(clipped, nums).select(F.lit("skewness").alias("report"), "column", F.col("skewness").alias("value"))
    pairs = correlation_pairs(clipped, nums, correlation_above)
    corr = pairs.select(F.lit("correlation").alias("report"), F.concat_ws("~", "column_a", "column_b").alias("column"), F.col("abs_r").alias("value"))
    return impute_columns(clipped, modes, token), raw.unionByName(levels).unionByName(skew).unionByName(corr)
