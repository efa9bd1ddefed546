"""Data-quality profile: one-pass aggregates returned as small report frames.

Scale notes
-----------
* Per-column statistics are computed in ONE aggregate over all columns
  (partial aggregation per task, a single tiny merge) and then turned long
  with ``inline`` (no Expand, no self-join).
* Category statistics go through ``level_counts``: (column, value) pairs are
  counted with map-side partial aggregation, so the shuffle carries distinct
  levels only, never rows.
* Exact quantiles (``exact_quantiles``) avoid Spark's ``percentile`` (which
  gathers every distinct value of a group into one task): a sketch brackets
  the wanted ranks and only the rows inside the brackets are counted by value
  and ranked (``selection``).  Results equal the linear interpolation of
  pandas ``quantile``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.functions.columns import MONTH_ORDER, WEEKDAY_ORDER, quoted
from leadlens.operators.selection import exact_quantiles_map, number

# Report thresholds.
RARE_LEVEL_COUNT = 50  # a level with fewer rows is flagged rare
HIGH_SKEW = 2.0  # |skew| above this is flagged HIGH
HIGH_CORRELATION = 0.8  # |r| above this is reported
UNKNOWN = "unknown"


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def _long(one_row: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn a one-row wide aggregate into a long report (one row per struct)."""
    return one_row.select(F.inline(F.array(*structs)))


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def _missing(df: DataFrame, c: str) -> Column:
    col = quoted(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


# ---------------------------------------------------------------------------
# Missing values, unknown tokens, cardinality
# ---------------------------------------------------------------------------
def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: NULL-or-NaN count and percent; only columns with any."""
    cols = list(columns or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.when(_missing(df, c), 1)).alias(f"_m{i}") for i, c in enumerate(cols)])
    rep = _long(
        agg,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_m{i}").alias("null_count"),
                (F.col(f"_m{i}") / F.col("_n") * 100).alias("null_pct"),
            )
            for i, c in enumerate(cols)
        ],
    )
    return rep.where(F.col("null_count") > 0)


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n): row count of every level of every column."""
    pairs = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns]))
    )
    return pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def unknown_report(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    token: str = UNKNOWN,
    impute: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per category: count and percent of ``token``, distinct levels and the
    planned strategy; sorted by percent descending."""
    cols = list(columns or string_columns(df))
    lv = level_counts(df, cols)
    strategy = F.lit("none")
    if keep:
        strategy = F.when(F.col("column").isin(*keep), "keep_as_category").otherwise(strategy)
    if impute:
        strategy = F.when(F.col("column").isin(*impute), "impute_mode").otherwise(strategy)
    rep = lv.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value") == token, F.col("n"))), F.lit(0)).alias("unknown_count"),
        F.sum("n").alias("_rows"),
        F.count(F.col("value")).alias("n_levels"),
    )
    return rep.select(
        "column",
        "unknown_count",
        (F.col("unknown_count") / F.col("_rows") * 100).alias("unknown_pct"),
        "n_levels",
        strategy.alias("strategy"),
    ).orderBy(F.desc("unknown_pct"), F.asc("column"))


def unknown_cooccurrence(df: DataFrame, columns: Sequence[str], token: str = UNKNOWN) -> DataFrame:
    """Pearson r between the 0/1 ``is unknown`` indicators of every column pair
    (upper triangle).  Integer sums keep it exact; NULL when a column is constant."""
    cols = list(columns)
    ind = {c: F.when(quoted(c) == token, 1).otherwise(0).cast("long") for c in cols}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs.append(F.sum(ind[c]).alias(f"_s{i}"))
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            aggs.append(F.sum(ind[cols[i]] * ind[cols[j]]).alias(f"_p{i}_{j}"))
    agg = df.agg(*aggs)
    n = F.col("_n").cast("double")
    structs = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            si, sj = F.col(f"_s{i}").cast("double"), F.col(f"_s{j}").cast("double")
            # for 0/1 columns sum(x^2) = sum(x)
            num = n * F.col(f"_p{i}_{j}") - si * sj
            den = (n * si - si * si) * (n * sj - sj * sj)
            structs.append(
                F.struct(
                    F.lit(cols[i]).alias("column_a"),
                    F.lit(cols[j]).alias("column_b"),
                    F.when(den > 0, num / F.sqrt(den)).alias("r"),
                )
            )
    return _long(agg, structs)


def cardinality_report(df: DataFrame, columns: Sequence[str] | None = None, rare: int = RARE_LEVEL_COUNT) -> DataFrame:
    """Per category: levels, smallest level count, rarest level (ties: smallest value), rare flag.
    NULL is not a level (like pandas ``value_counts``)."""
    cols = list(columns or string_columns(df))
    lv = level_counts(df, cols).where(F.col("value").isNotNull())
    rep = lv.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_levels"),
        F.min("n").alias("min_count"),
        F.min_by("value", F.struct("n", "value")).alias("rarest_level"),
    )
    return rep.withColumn("rare", F.col("min_count") < rare)


def value_counts_topn(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """Normalised value counts of one column, top ``n`` (ties by value)."""
    vc = df.groupBy(quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return vc.select("value", "n", (F.col("n") / F.lit(float(total))).alias("share")).orderBy(
        F.desc("n"), F.asc("value")
    ).limit(n)


def class_balance(df: DataFrame, target: str = "y") -> DataFrame:
    """Count and percent per target class (the window runs over the class rows only)."""
    c = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()
    return c.select(target, "n", (F.col("n") / F.sum("n").over(w) * 100).alias("pct"))


def dataset_overview(raw: DataFrame, target: str = "y", drop: Sequence[str] = ()) -> DataFrame:
    """Raw rows, rows after exact de-duplication (NULL = NULL), removed rows,
    feature columns and the positive rate; one pass, one row."""
    kept = [c for c in raw.columns if c not in drop]
    row = F.struct(*[quoted(c) for c in kept])
    return raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_distinct(row).alias("dedup_rows"),
        F.avg(quoted(target).cast("double")).alias("positive_rate"),
    ).select(
        "raw_rows",
        "dedup_rows",
        (F.col("raw_rows") - F.col("dedup_rows")).alias("duplicates_removed"),
        F.lit(len(kept)).alias("n_columns"),
        "positive_rate",
    )


# ---------------------------------------------------------------------------
# Numeric summaries
# ---------------------------------------------------------------------------
def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(column, prob, value): exact linear-interpolation quantiles of every column (NULL and NaN skipped).

    h = (n-1)*q; value = x[floor h] + (h - floor h) * (x[floor h + 1] - x[floor h]).  See ``selection``; a column without values has no row.
    """
    found = quantile_map(df, columns, probs)
    return df.sparkSession.createDataFrame([(c, q, v) for (c, q), v in found.items()], "column string, prob double, value double")


def quantile_map(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], float]:
    """The (few) quantile values on the driver: #columns x #probs numbers."""
    return exact_quantiles_map(df, columns, probs)


def _skew_kurt(c: Column) -> tuple[Column, Column, Column]:
    """Sample-size-corrected skewness and excess kurtosis (pandas ``skew``/``kurt``)
    from Spark's population ``skewness``/``kurtosis``."""
    n = F.count(c).cast("double")
    g1, g2 = F.skewness(c), F.kurtosis(c)
    skew = F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    return n, skew, kurt


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std (sample), min, q25, median, q75, max, skew, kurtosis per column."""
    cols = list(columns or numeric_columns(df))
    q = quantile_map(df, cols, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(cols):
        x = number(c)
        _, sk, ku = _skew_kurt(x)
        aggs += [
            F.count(x).alias(f"_n{i}"),
            F.avg(x).alias(f"_mean{i}"),
            F.stddev_samp(x).alias(f"_std{i}"),
            F.min(x).alias(f"_min{i}"),
            F.max(x).alias(f"_max{i}"),
            sk.alias(f"_sk{i}"),
            ku.alias(f"_ku{i}"),
        ]
    return _long(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_n{i}").alias("count"),
                F.col(f"_mean{i}").alias("mean"),
                F.col(f"_std{i}").alias("std"),
                F.col(f"_min{i}").alias("min"),
                *[F.lit(q.get((c, p))).cast("double").alias(name) for p, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))],
                F.col(f"_max{i}").alias("max"),
                F.col(f"_sk{i}").alias("skewness"),
                F.col(f"_ku{i}").alias("kurtosis"),
            )
            for i, c in enumerate(cols)
        ],
    )


def skewness_report(df: DataFrame, columns: Sequence[str] | None = None, high: float = HIGH_SKEW) -> DataFrame:
    """Skewness and kurtosis (pandas definitions) per column, HIGH when |skew| > 2."""
    cols = list(columns or numeric_columns(df))
    aggs = []
    for i, c in enumerate(cols):
        _, sk, ku = _skew_kurt(number(c))
        aggs += [sk.alias(f"_sk{i}"), ku.alias(f"_ku{i}")]
    rep = _long(
        df.agg(*aggs),
        [F.struct(F.lit(c).alias("column"), F.col(f"_sk{i}").alias("skewness"), F.col(f"_ku{i}").alias("kurtosis")) for i, c in enumerate(cols)],
    )
    return rep.withColumn("flag", F.when(F.abs("skewness") > high, "HIGH").otherwise("OK"))


def correlation_matrix(df: DataFrame, columns: Sequence[str], pairs: str = "all") -> DataFrame:
    """Pearson r of column pairs from one aggregate; ``pairs='upper'`` keeps i<j only.
    Above ~50 columns, ``pyspark.ml.stat.Correlation`` on an assembled vector
    is the cheaper plan (one pass over a dense matrix)."""
    cols = list(columns)
    idx = [(i, j) for i in range(len(cols)) for j in range(len(cols)) if (i < j if pairs == "upper" else True)]
    if not idx:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, r double")
    uniq = sorted({(min(i, j), max(i, j)) for i, j in idx if i != j})
    agg = df.agg(*[F.corr(number(cols[i]), number(cols[j])).alias(f"_r{i}_{j}") for i, j in uniq], F.lit(1.0).alias("_one"))
    structs = []
    for i, j in idx:
        r = F.col("_one") if i == j else F.col(f"_r{min(i, j)}_{max(i, j)}")
        structs.append(F.struct(F.lit(cols[i]).alias("column_a"), F.lit(cols[j]).alias("column_b"), r.alias("r")))
    return _long(agg, structs)


def correlation_pairs(df: DataFrame, columns: Sequence[str], threshold: float = HIGH_CORRELATION) -> DataFrame:
    """Upper-triangle pairs with |r| above the threshold."""
    m = correlation_matrix(df, columns, pairs="upper")
    return m.select("column_a", "column_b", F.abs("r").alias("abs_r")).where(F.col("abs_r") > threshold)


def point_biserial(df: DataFrame, columns: Sequence[str], target: str = "y") -> DataFrame:
    """|r| of each numeric column (NULL/NaN -> column median) against the target."""
    cols = list(columns)
    med = quantile_map(df, cols, [0.5])
    filled = {
        c: F.when(_missing(df, c), F.lit(med.get((c, 0.5)))).otherwise(quoted(c).cast("double")) for c in cols
    }
    agg = df.agg(*[F.corr(filled[c], quoted(target).cast("double")).alias(f"_r{i}") for i, c in enumerate(cols)])
    return _long(agg, [F.struct(F.lit(c).alias("column"), F.abs(F.col(f"_r{i}")).alias("abs_r")) for i, c in enumerate(cols)])


def outlier_report(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Per column: values outside [q_low, q_high] and the bounds; only columns with any."""
    cols = list(columns)
    qm = quantile_map(df, cols, [low, high])
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        lo, hi = qm.get((c, low)), qm.get((c, high))
        x = number(c)
        aggs.append(F.count(F.when(x < F.lit(lo), 1)).alias(f"_lo{i}"))
        aggs.append(F.count(F.when(x > F.lit(hi), 1)).alias(f"_hi{i}"))
    rep = _long(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_lo{i}").alias("n_low"),
                F.col(f"_hi{i}").alias("n_high"),
                (F.col(f"_lo{i}") + F.col(f"_hi{i}")).alias("n_outliers"),
                ((F.col(f"_lo{i}") + F.col(f"_hi{i}")) / F.col("_rows") * 100).alias("pct"),
                F.lit(qm.get((c, low))).cast("double").alias("low_bound"),
                F.lit(qm.get((c, high))).cast("double").alias("high_bound"),
            )
            for i, c in enumerate(cols)
        ],
    )
    return rep.where(F.col("n_outliers") > 0)


# ---------------------------------------------------------------------------
# Conversion analyses
# ---------------------------------------------------------------------------
def _rate(target: str) -> Column:
    return F.avg(quoted(target).cast("double")) * 100


def conversion_by_category(
    df: DataFrame, column: str, target: str = "y", top_n: int | None = None, lift_mark: float = 1.3
) -> DataFrame:
    """Conversion rate (%) and volume per level, with the lift over the
    overall rate and marks at 1x and ``lift_mark``x; sorted by rate."""
    base = df.agg(_rate(target)).first()[0]
    g = df.groupBy(quoted(column).alias("level")).agg(_rate(target).alias("conversion_pct"), F.count(F.lit(1)).alias("n"))
    g = g.select(
        "level",
        "conversion_pct",
        "n",
        (F.col("conversion_pct") / F.lit(base)).alias("lift"),
        (F.col("conversion_pct") > F.lit(base)).alias("above_base"),
        (F.col("conversion_pct") > F.lit(base * lift_mark)).alias("above_mark"),
    )
    g = g.orderBy(F.desc("conversion_pct"), F.asc("level"))
    return g.limit(top_n) if top_n else g


def conversion_by_ordered(
    df: DataFrame, column: str, order: Sequence[str] | None = None, target: str = "y"
) -> DataFrame:
    """Rate and volume in calendar order; levels absent from the data stay
    as rows with NULL (the calendar is the left side of the join)."""
    levels = list(order or (MONTH_ORDER if column.startswith("month") else WEEKDAY_ORDER))
    spark = df.sparkSession
    cal = spark.createDataFrame([(i + 1, v) for i, v in enumerate(levels)], "ordinal int, level string")
    g = df.groupBy(quoted(column).alias("level")).agg(_rate(target).alias("conversion_pct"), F.count(F.lit(1)).alias("n"))
    # the calendar has a fixed, tiny size: broadcasting it is bounded
    g = g.where(F.col("level").isin(levels))  # as many rows as the calendar has
    return cal.join(F.broadcast(g), "level", "left").select("ordinal", "level", "conversion_pct", "n").orderBy("ordinal")


def conversion_by_bin(df: DataFrame, bin_col: Column | str, target: str = "y", name: str = "bin") -> DataFrame:
    """Rate and volume per bin (bins from ``cut_bins`` / ``equal_width_bins``)."""
    b = bin_col if isinstance(bin_col, Column) else quoted(bin_col)
    return df.groupBy(b.alias(name)).agg(_rate(target).alias("conversion_pct"), F.count(F.lit(1)).alias("n"))


def conversion_by_sentinel(df: DataFrame, column: str = "pdays", sentinel: int = 999, target: str = "y") -> DataFrame:
    return df.groupBy((quoted(column) == F.lit(sentinel)).alias("is_sentinel")).agg(
        _rate(target).alias("conversion_pct"), F.count(F.lit(1)).alias("n")
    )


def equal_width_bins(df: DataFrame, column: str, n: int, out: str | None = None) -> DataFrame:
    """Add a 1..n equal-width bin index over the column's [min, max] (pandas ``cut(bins=n)``).
    The bounds are one tiny aggregate; they enter the plan as literals."""
    from leadlens.functions.columns import equal_width_index

    x = quoted(column).cast("double")
    lo, hi = df.agg(F.min(F.when(~F.isnan(x), x)), F.max(F.when(~F.isnan(x), x))).first()
    return df.withColumn(out or f"{column}_bin", equal_width_index(x, F.lit(lo), F.lit(hi), n))


def histogram(df: DataFrame, column: str, lo: float, hi: float, bins: int) -> DataFrame:
    """numpy-style histogram: edges linspace(lo, hi, bins+1), [a, b) bins and a
    closed last bin; values outside [lo, hi] are ignored.  Empty bins give 0."""
    import numpy as np

    from leadlens.operators.evaluate import range_number

    edges = [float(e) for e in np.linspace(lo, hi, bins + 1)]
    x = quoted(column).cast("double")
    inside = df.select(x.alias("_x")).where((F.col("_x") >= lo) & (F.col("_x") <= hi))
    # bin = (#inner edges <= x), so [a, b) bins; the top edge closes the last bin
    inside = range_number(inside, "_x", edges[1:-1], "_inner")
    idx = F.least(F.col("_inner"), F.lit(bins - 1))
    counts = inside.groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    frame = spark.createDataFrame([(i, edges[i], edges[i + 1]) for i in range(bins)], "bin int, lower double, upper double")
    return frame.join(counts, "bin", "left").select("bin", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n"))

