"""Evaluation in metrics and in dollars.

Design for scale
----------------
* Everything starts from an aggregate *by distinct score* (``score_table``):
  map-side partial aggregation collapses a hot score value to one row before
  the shuffle, so skew in scores cannot overload a task.
* Cumulative counts over the score order (ROC, average precision, curves) are
  prefix sums computed in two levels (``prefix_sums``): score ranges cut at
  approximate quantiles of the raw scores, a window inside each range
  (partitioned, so many tasks) and a window over the totals of the ranges,
  joined back null-safe, so that a NULL group keeps its rows.
* Threshold sweeps never form rows x thresholds: every row is bucketed onto
  the sorted grid (arithmetic index checked against the exact grid values), the
  buckets are counted (at most grid+1 groups) and a suffix sum over that tiny
  table gives the confusion matrix of every threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------
COST_FP = 5.0  # one wasted call
COST_FN = 200.0  # one missed subscriber
VALUE_TP = 200.0  # one subscriber found (net of the call: 195)
ANNUAL_NIM = 640.0  # yearly net-interest revenue of one subscriber
LIFETIME_NIM = 1280.0  # over the average two-year term
BASE_CONVERSION = 0.113  # population conversion rate used by campaign impact
LOG_LOSS_EPS = float(np.finfo(np.float64).eps)
# Threshold grid of the optimal-threshold search: linspace(0.05, 0.95, 200).
GRID_START, GRID_STOP, GRID_STEPS = 0.05, 0.95, 200
# Thresholds of the recall analysis: arange(0.05, 0.95, 0.05).
RECALL_START, RECALL_STOP, RECALL_STEP = 0.05, 0.95, 0.05


class LinearGrid(list):
    """Sorted threshold values t_i = i*step + start (i < n), optionally with the
    last value pinned to ``last`` — exactly how numpy's linspace/arange build
    them — plus an O(1) column expression for "how many t_i are <= p"."""

    def __init__(self, start: float, step: float, n: int, last: float | None = None):
        vals = [float(i * step + start) for i in range(n)]
        if last is not None and n > 1:
            vals[-1] = float(last)
        super().__init__(vals)
        self.start, self.step, self.n, self.last = float(start), float(step), n, last

    def value_at(self, i: Column) -> Column:
        v = i.cast("double") * F.lit(self.step) + F.lit(self.start)
        return F.when(i == self.n - 1, F.lit(self[-1])).otherwise(v) if self.last is not None else v

    def count_at_most(self, p: Column) -> Column:
        # floor() of the division is off by at most one next to a grid value;
        # compare with the exact neighbouring grid values to settle it.
        j = F.least(F.greatest(F.floor((p - F.lit(self.start)) / F.lit(self.step)), F.lit(-1)), F.lit(self.n - 1))
        up = (j + 1 <= self.n - 1) & (self.value_at(j + 1) <= p)
        down = (j >= 0) & (self.value_at(j) > p)
        return (F.when(up, j + 2).when(down, j).otherwise(j + 1)).cast("int")


def linspace(start: float, stop: float, n: int) -> LinearGrid:
    """Grid values exactly as ``numpy.linspace`` produces them (i*step + start, last = stop)."""
    g = LinearGrid(start, (stop - start) / (n - 1), n, stop)
    assert list(g) == [float(x) for x in np.linspace(start, stop, n)]
    return g


def arange(start: float, stop: float, step: float) -> LinearGrid:
    """Values exactly as ``numpy.arange`` produces them (start + i*delta)."""
    n = int(np.ceil((stop - start) / step))
    g = LinearGrid(start, (start + step) - start, n)
    assert list(g) == [float(x) for x in np.arange(start, stop, step)]
    return g


def _by(by: Sequence[str] | str | None) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _label_int(label: str) -> Column:
    return F.col(label).cast("int")


def _predicate(prob: str, threshold: float | Column | None, pred: str | None) -> Column:
    if pred is not None:
        return F.col(pred).cast("int") == 1
    if threshold is None:
        raise ValueError("give a threshold or a prediction column")
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return valid_probability(F.col(prob)) >= t


def valid_probability(p: Column) -> Column:
    """The probability; a NULL or NaN one fails the job instead of vanishing from counts or counting as a call."""
    p = p.cast("double")
    return F.when(p.isNotNull() & ~F.isnan(p), p).otherwise(F.raise_error(F.lit("probability is NULL or NaN")).cast("double"))


# ---------------------------------------------------------------------------
# Confusion matrix and business cost
# ---------------------------------------------------------------------------
def confusion_aggs(label: str, predicted: Column) -> list[Column]:
    y = _label_int(label) == 1
    n = lambda cond: F.count(F.when(cond, 1))
    return [
        n(~y & ~predicted).alias("tn"),
        n(~y & predicted).alias("fp"),
        n(y & ~predicted).alias("fn"),
        n(y & predicted).alias("tp"),
    ]


def confusion(
    df: DataFrame,
    label: str = "y",
    prob: str = "probability",
    threshold: float | Column | None = 0.5,
    pred: str | None = None,
    by: Sequence[str] | str | None = None,
) -> DataFrame:
    """tn, fp, fn, tp (one row, or one per ``by`` group).  A single class gives zeros, not an error."""
    keys = _by(by)
    aggs = confusion_aggs(label, _predicate(prob, threshold, pred))
    return df.groupBy(*keys).agg(*aggs)


def profit_expr(tp: Column, fp: Column, fn: Column, value_tp=VALUE_TP, cost_fp=COST_FP, cost_fn=COST_FN) -> Column:
    return tp * F.lit(value_tp - cost_fp) - fp * F.lit(cost_fp) - fn * F.lit(cost_fn)


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def business_cost_analysis(
    df: DataFrame,
    label: str = "y",
    prob: str = "probability",
    threshold: float | Column | None = 0.5,
    pred: str | None = None,
    by: Sequence[str] | str | None = None,
) -> DataFrame:
    """Confusion matrix translated into dollars: 17 figures per group."""
    keys = _by(by)
    c = confusion(df, label, prob, threshold, pred, keys)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    total = tp + fp + fn + tn
    net = profit_expr(tp, fp, fn)
    return c.select(
        *keys,
        tp,
        fp,
        fn,
        tn,
        (tp * F.lit(VALUE_TP - COST_FP)).alias("revenue"),
        (fp * F.lit(COST_FP)).alias("wasted_cost"),
        (fn * F.lit(COST_FN)).alias("missed_opportunity"),
        net.alias("net_profit"),
        _safe_div(net, total).alias("profit_per_client"),
        (tp + fp).alias("calls_made"),
        total.alias("total_clients"),
        tp.alias("subscribers_found"),
        fn.alias("subscribers_missed"),
        _safe_div(tp, tp + fn).alias("catch_rate"),
        _safe_div(tp, tp + fp).alias("call_efficiency"),
        (fn * F.lit(ANNUAL_NIM)).alias("missed_annual_nim"),
        (fn * F.lit(LIFETIME_NIM)).alias("missed_lifetime_nim"),
    )


# ---------------------------------------------------------------------------
# Distinct-score table and distributed prefix sums
# ---------------------------------------------------------------------------
def score_table(
    df: DataFrame,
    label: str = "y",
    prob: str = "probability",
    by: Sequence[str] | str | None = None,
    predicted: Column | None = None,
) -> DataFrame:
    """One row per (group, distinct score): positives, negatives and the
    per-score partial sums that log loss and Brier need.  Partial aggregation
    happens map-side before the shuffle."""
    keys = _by(by)
    y = _label_int(label)
    p = valid_probability(F.col(prob))
    pc = F.greatest(F.least(p, F.lit(1.0 - LOG_LOSS_EPS)), F.lit(LOG_LOSS_EPS))
    aggs = [
        F.count(F.when(y == 1, 1)).alias("pos"),
        F.count(F.when(y == 0, 1)).alias("neg"),
        F.sum(F.when(y == 1, -F.log(pc)).otherwise(-F.log(F.lit(1.0) - pc))).alias("ll_sum"),
        F.sum((p - y) * (p - y)).alias("sq_sum"),
    ]
    if predicted is not None:
        aggs += confusion_aggs(label, predicted)
    return df.groupBy(*keys, p.alias("score")).agg(*aggs)


def score_ranges(df: DataFrame, column: str, n_ranges: int | None = None) -> list[float]:
    """Cuts at approximate quantiles of a column's rows (one sketch pass, no shuffle; at most ``n_ranges - 1`` numbers),
    so that no range holds many more than one in ``n_ranges`` of the rows, whatever their groups, but for rows of one value."""
    if n_ranges is None:
        n_ranges = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")) * 2)
    if n_ranges <= 1:
        return []
    cuts = df.approxQuantile(column, [i / n_ranges for i in range(1, n_ranges)], 1.0 / (4 * n_ranges))
    return sorted({float(e) for e in cuts if e is not None and np.isfinite(e)})


def range_number(df: DataFrame, column: str, cuts: Sequence[float], out: str) -> DataFrame:
    """``out``: the number of sorted ``cuts`` that are <= the column, by the JVM's binary search (NULL and NaN lie beyond the last)."""
    from pyspark.ml.feature import Bucketizer

    if not len(cuts):
        return df.withColumn(out, F.lit(0))
    search = Bucketizer(splits=[-np.inf, *map(float, cuts), np.inf], inputCol=column, outputCol=out, handleInvalid="keep")
    return search.transform(df).withColumn(out, F.col(out).cast("int"))


def prefix_sums(
    table: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    by: Sequence[str] | str | None = None,
    cuts: Sequence[float] = (),
    descending: bool = True,
) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ``order_col`` order within
    each ``by`` group (NULL is a group), plus group totals (``<col>_total``).

    Two levels: a window per (group, range) and a window over the totals of
    a group's ranges.  ``cuts`` cut the order column into ranges; any cuts give
    the same sums.
    """
    keys = _by(by)
    t = range_number(table, order_col, cuts, "_range")
    totals = t.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_r_{c}") for c in sum_cols])
    order = F.desc("_range") if descending else F.asc("_range")
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_range").alias("_of"),
        *[F.coalesce(F.sum(f"_r_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.sum(f"_r_{c}").over(whole).alias(f"{c}_total") for c in sum_cols],
    )
    same = F.col("_range") == F.col("_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inner = F.desc(order_col) if descending else F.asc(order_col)
    within = Window.partitionBy(*keys, "_range").orderBy(inner).rowsBetween(Window.unboundedPreceding, 0)
    summed = t.withColumns({f"_in_{c}": F.sum(c).over(within) for c in sum_cols})
    return summed.join(offsets, same).select(
        *table.columns,
        *[(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"cum_{c}") for c in sum_cols],
        *[F.col(f"{c}_total") for c in sum_cols],
    )


def cumulative_scores(
    df: DataFrame,
    label: str = "y",
    prob: str = "probability",
    by: Sequence[str] | str | None = None,
    predicted: Column | None = None,
    n_ranges: int | None = None,
) -> DataFrame:
    """Distinct scores with ``cum_pos``/``cum_neg`` = counts with score >= s.

    The rows are read twice: by the sketch that cuts the scores into ranges, and by the aggregate that leaves one row per distinct
    score.  Scores that are dear to compute are best written first."""
    cuts = score_ranges(df.select(F.col(prob).cast("double").alias("p")), "p", n_ranges)
    return prefix_sums(score_table(df, label, prob, by, predicted), "score", ["pos", "neg"], by, cuts, descending=True)


# ---------------------------------------------------------------------------
# Ranking metrics
# ---------------------------------------------------------------------------
def _rank_aggs() -> list[Column]:
    """ROC-AUC (tie-aware Mann-Whitney, exact integer numerator) and average
    precision over a ``cumulative_scores`` frame."""
    pos, neg = F.col("pos").cast("decimal(38,0)"), F.col("neg").cast("decimal(38,0)")
    cum_neg = F.col("cum_neg").cast("decimal(38,0)")
    n_total = F.col("neg_total").cast("decimal(38,0)")
    # 2 * sum(pos_s * (neg_below_s + neg_s / 2)), neg_below_s = N - cum_neg_s
    twice_u = F.sum(pos * (F.lit(2) * (n_total - cum_neg) + neg))
    pn = F.first("pos_total").cast("double") * F.first("neg_total").cast("double")
    roc = F.when(pn > 0, twice_u.cast("double") / (F.lit(2.0) * pn))
    precision_at = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    ap = F.sum(F.col("pos") * precision_at) / F.first("pos_total")
    return [roc.alias("roc_auc"), F.when(F.first("pos_total") > 0, ap).alias("pr_auc")]


def roc_auc(df: DataFrame, label="y", prob="probability", by=None, n_ranges=None) -> DataFrame:
    keys = _by(by)
    cum = cumulative_scores(df, label, prob, keys, n_ranges=n_ranges)
    return cum.groupBy(*keys).agg(_rank_aggs()[0])


def pr_auc(df: DataFrame, label="y", prob="probability", by=None, n_ranges=None) -> DataFrame:
    keys = _by(by)
    cum = cumulative_scores(df, label, prob, keys, n_ranges=n_ranges)
    return cum.groupBy(*keys).agg(_rank_aggs()[1])


def compute_metrics(
    df: DataFrame,
    label: str = "y",
    prob: str = "probability",
    threshold: float | Column | None = 0.5,
    pred: str | None = None,
    by: Sequence[str] | str | None = None,
    n_ranges: int | None = None,
    counts: bool = False,
) -> DataFrame:
    """accuracy, precision, recall, f1, roc_auc, pr_auc, log_loss, mcc, brier_score
    (zero on zero division) from one distinct-score pass; ``counts`` keeps tp/fp/fn/tn."""
    keys = _by(by)
    predicted = _predicate(prob, threshold, pred)
    cum = cumulative_scores(df, label, prob, keys, predicted, n_ranges)
    agg = cum.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")],
        *_rank_aggs(),
        (F.sum("ll_sum") / (F.sum("pos") + F.sum("neg"))).alias("log_loss"),
        (F.sum("sq_sum") / (F.sum("pos") + F.sum("neg"))).alias("brier_score"),
    )
    extra = ["tp", "fp", "fn", "tn"] if counts else []
    return agg.select(*keys, *metric_columns(), "roc_auc", "pr_auc", "log_loss", "brier_score", *extra)


def metric_columns() -> list[Column]:
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    denom = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    return [
        _safe_div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.when(denom > 0, (tp * tn - fp * fn) / F.sqrt(denom)).otherwise(F.lit(0.0)).alias("mcc"),
    ]


def log_loss(df: DataFrame, label="y", prob="probability", by=None) -> DataFrame:
    keys = _by(by)
    y = _label_int(label)
    pc = F.greatest(F.least(valid_probability(F.col(prob)), F.lit(1.0 - LOG_LOSS_EPS)), F.lit(LOG_LOSS_EPS))
    return df.groupBy(*keys).agg(F.avg(F.when(y == 1, -F.log(pc)).otherwise(-F.log(1 - pc))).alias("log_loss"))


def brier_score(df: DataFrame, label="y", prob="probability", by=None) -> DataFrame:
    keys = _by(by)
    d = valid_probability(F.col(prob)) - _label_int(label)
    return df.groupBy(*keys).agg(F.avg(d * d).alias("brier_score"))


def mcc(df: DataFrame, label="y", prob="probability", threshold=0.5, pred=None, by=None) -> DataFrame:
    keys = _by(by)
    c = confusion(df, label, prob, threshold, pred, keys)
    return c.select(*keys, *[m for m in metric_columns() if "mcc" in str(m)])


def roc_curve(df: DataFrame, label="y", prob="probability", by=None, n_ranges=None) -> DataFrame:
    """One point per distinct score (descending): fpr, tpr, precision, recall."""
    keys = _by(by)
    cum = cumulative_scores(df, label, prob, keys, n_ranges=n_ranges)
    return cum.select(
        *keys,
        F.col("score").alias("threshold"),
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        _safe_div(F.col("cum_neg").cast("double"), F.col("neg_total")).alias("fpr"),
        _safe_div(F.col("cum_pos").cast("double"), F.col("pos_total")).alias("tpr"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
    )


def classification_report(
    df: DataFrame, label="y", prob="probability", threshold=0.5, pred=None
) -> DataFrame:
    """Per-class precision/recall/F1/support plus accuracy, macro and weighted rows."""
    c = confusion(df, label, prob, threshold, pred)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1_ = lambda p, r: _safe_div(2 * p * r, p + r)
    s1, s0 = tp + fn, tn + fp
    acc = _safe_div(tp + tn, n)
    rows = F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"), f1_(p0, r0).alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"), f1_(p1, r1).alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"), n.alias("support")),
        F.struct(
            F.lit("macro avg").alias("class"),
            ((p0 + p1) / 2).alias("precision"),
            ((r0 + r1) / 2).alias("recall"),
            ((f1_(p0, r0) + f1_(p1, r1)) / 2).alias("f1"),
            n.alias("support"),
        ),
        F.struct(
            F.lit("weighted avg").alias("class"),
            _safe_div(p0 * s0 + p1 * s1, n).alias("precision"),
            _safe_div(r0 * s0 + r1 * s1, n).alias("recall"),
            _safe_div(f1_(p0, r0) * s0 + f1_(p1, r1) * s1, n).alias("f1"),
            n.alias("support"),
        ),
    )
    return c.select(F.inline(rows))


# ---------------------------------------------------------------------------
# Threshold sweeps
# ---------------------------------------------------------------------------
def threshold_sweep(
    df: DataFrame,
    thresholds: Sequence[float],
    label: str = "y",
    prob: str = "probability",
    by: Sequence[str] | str | None = None,
    value_tp: float = VALUE_TP,
    cost_fp: float = COST_FP,
    cost_fn: float = COST_FN,
) -> DataFrame:
    """Confusion matrix and profit at every threshold (``prob >= t``).

    Rows are placed on the sorted thresholds by binary search, so the
    work is one pass plus an aggregate with at most len(thresholds)+1 groups
    per ``by`` group; no rows x thresholds product is formed.  A NULL or NaN
    probability fails the job; NULL is a group like any other.
    """
    keys = _by(by)
    ts = thresholds if isinstance(thresholds, LinearGrid) else sorted({float(t) for t in thresholds})
    n = len(ts)
    spark: SparkSession = df.sparkSession
    scored = df.select(*keys, _label_int(label).alias("_y"), valid_probability(F.col(prob)).alias("_p"))
    # _k = number of thresholds <= p; threshold i (1-based) calls rows with _k >= i.
    if isinstance(ts, LinearGrid):
        b = scored.withColumn("_k", ts.count_at_most(F.col("_p")))
    else:
        b = range_number(scored, "_p", ts, "_k")
    hist = b.groupBy(*keys, F.col("_k").cast("int").alias("_k")).agg(
        F.count(F.when(F.col("_y") == 1, 1)).alias("_pos"), F.count(F.when(F.col("_y") == 0, 1)).alias("_neg")
    )
    # every place 0..n of every group is there, with zeros if no row is; then a suffix sum over n+1 rows per group
    groups = hist.groupBy(*keys).agg(F.lit(1).alias("_one")) if keys else spark.range(1)
    zeros = groups.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(n))).alias("_k"), *[F.lit(0).cast("long").alias(c) for c in ("_pos", "_neg")])
    full = hist.unionByName(zeros).groupBy(*keys, "_k").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    w_suffix = Window.partitionBy(*keys).orderBy(F.desc("_k")).rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy(*keys)
    sfx = full.select(
        *keys,
        "_k",
        F.sum("_pos").over(w_suffix).alias("tp"),
        F.sum("_neg").over(w_suffix).alias("fp"),
        F.sum("_pos").over(w_all).alias("_P"),
        F.sum("_neg").over(w_all).alias("_N"),
    )
    if isinstance(ts, LinearGrid):
        thr = ts.value_at(F.col("_k") - 1)
    else:
        thr = F.element_at(F.array(*[F.lit(t) for t in ts]), F.col("_k"))
    out = sfx.where(F.col("_k") >= 1).select(
        *keys,
        thr.alias("threshold"),
        "tp",
        "fp",
        (F.col("_P") - F.col("tp")).alias("fn"),
        (F.col("_N") - F.col("fp")).alias("tn"),
    )
    return out.withColumn(
        "net_profit", profit_expr(F.col("tp"), F.col("fp"), F.col("fn"), value_tp, cost_fp, cost_fn).cast("double")
    )


def find_optimal_threshold(
    df: DataFrame,
    label: str = "y",
    prob: str = "probability",
    by: Sequence[str] | str | None = None,
    cost_fp: float = COST_FP,
    cost_fn: float = COST_FN,
    value_tp: float = VALUE_TP,
    n_steps: int = GRID_STEPS,
    start: float = GRID_START,
    stop: float = GRID_STOP,
) -> DataFrame:
    """Most profitable threshold on ``linspace(start, stop, n_steps)``;
    the lowest threshold wins ties.  One row per group: threshold, net_profit."""
    keys = _by(by)
    sweep = threshold_sweep(df, linspace(start, stop, n_steps), label, prob, keys, value_tp, cost_fp, cost_fn)
    w = Window.partitionBy(*keys).orderBy(F.desc("net_profit"), F.asc("threshold"))
    return (
        sweep.withColumn("_rn", F.row_number().over(w))
        .where("_rn = 1")
        .select(*keys, "threshold", "net_profit")
    )


def profit_curve(
    df: DataFrame,
    label: str = "y",
    prob: str = "probability",
    by: Sequence[str] | str | None = None,
    start: float = GRID_START,
    stop: float = GRID_STOP,
    n_steps: int = 100,
    value_tp: float = VALUE_TP,
    cost_fp: float = COST_FP,
    cost_fn: float = COST_FN,
) -> DataFrame:
    """The whole profit curve with recall, precision and false-positive rate."""
    keys = _by(by)
    sweep = threshold_sweep(df, linspace(start, stop, n_steps), label, prob, keys, value_tp, cost_fp, cost_fn)
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    return sweep.select(
        *keys,
        "threshold",
        "tp",
        "fp",
        "fn",
        "tn",
        "net_profit",
        _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(tp, tp + fp).alias("precision"),
        _safe_div(fp, fp + tn).alias("fpr"),
    )


def recall_analysis(
    df: DataFrame,
    label: str = "y",
    prob: str = "probability",
    thresholds: Sequence[float] | None = None,
    by: Sequence[str] | str | None = None,
) -> DataFrame:
    """Recall / precision / calls / profit trade-off at fixed thresholds
    (default ``arange(0.05, 0.95, 0.05)``), rounded like the report."""
    keys = _by(by)
    ts = thresholds if thresholds is not None else arange(RECALL_START, RECALL_STOP, RECALL_STEP)
    sweep = threshold_sweep(df, ts, label, prob, keys)
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    return sweep.select(
        *keys,
        F.round("threshold", 2).alias("threshold"),
        F.round(_safe_div(tp, tp + fn), 3).alias("recall"),
        F.round(_safe_div(tp, tp + fp), 3).alias("precision"),
        (F.col("tp") + F.col("fp")).alias("calls_made"),
        F.col("tp").alias("subscribers_caught"),
        F.col("fn").alias("subscribers_missed"),
        F.col("fp").alias("false_alarms"),
        F.round("net_profit", 0).alias("net_profit"),
        F.round(fn * F.lit(ANNUAL_NIM), 0).alias("missed_nim_revenue"),
    )


# ---------------------------------------------------------------------------
# Model-level comparisons (inputs: one row per model)
# ---------------------------------------------------------------------------
def model_comparison(
    df: DataFrame,
    model: str = "model",
    label: str = "y",
    prob: str = "probability",
    thresholds: Mapping[str, float] | None = None,
    n_ranges: int | None = None,
) -> DataFrame:
    """One row per model: threshold, the nine metrics, confusion counts and net profit.

    ``thresholds`` defaults to each model's optimal threshold on the same
    rows.  Thresholds are one number per model, so they are collected and
    applied as a map literal: the metric pass is a single grouped aggregate
    with no join back to the rows."""
    if thresholds is None:
        thresholds = {r[model]: r["threshold"] for r in find_optimal_threshold(df, label, prob, by=model).collect()}
    tmap = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(float(v)))])
    scored = df.withColumn("threshold", tmap[F.col(model)])
    m = compute_metrics(scored, label, prob, threshold=F.col("threshold"), by=[model, "threshold"], n_ranges=n_ranges, counts=True)
    return m.withColumn("net_profit", profit_expr(F.col("tp"), F.col("fp"), F.col("fn")).cast("double"))


def select_best_model(comparison: DataFrame, model: str = "model", profit: str = "net_profit") -> DataFrame:
    """The most profitable model (name breaks ties); the input is not changed."""
    return comparison.orderBy(F.desc(profit), F.asc(model)).limit(1)


# Criteria for "best per criterion": True = higher is better.
CRITERIA = {
    "roc_auc": True,
    "pr_auc": True,
    "accuracy": True,
    "precision": True,
    "recall": True,
    "f1": True,
    "net_profit": True,
    "mcc": True,
    "log_loss": False,
    "brier_score": False,
}


def best_per_criterion(comparison: DataFrame, model: str = "model", criteria: Mapping[str, bool] | None = None) -> DataFrame:
    """Winner for each metric (max, or min for losses); ties go to the first name."""
    crit = dict(criteria or CRITERIA)
    long = comparison.select(
        model,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("criterion"),
                        F.col(k).cast("double").alias("value"),
                        (F.col(k).cast("double") * F.lit(1.0 if hi else -1.0)).alias("_signed"),
                    )
                    for k, hi in crit.items()
                ]
            )
        ),
    )
    w = Window.partitionBy("criterion").orderBy(F.desc("_signed"), F.asc(model))
    return long.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(
        "criterion", F.col(model).alias("winner"), "value"
    )


def wins_per_model(best: DataFrame) -> DataFrame:
    return best.groupBy("winner").agg(F.count(F.lit(1)).alias("wins"))


def strategy_compare(
    df: DataFrame,
    thresholds: DataFrame | Mapping[str, float],
    model: str = "model",
    label: str = "y",
    prob: str = "probability",
    charge_missed: bool = False,
) -> DataFrame:
    """Call nobody / call everybody / each model at its threshold:
    profit, calls, conversions and profit per call (0 with no calls)."""
    if isinstance(thresholds, DataFrame):  # one row per model
        thresholds = {r[model]: r["threshold"] for r in thresholds.select(model, "threshold").collect()}
    tmap = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(float(v)))])
    per_model = business_cost_analysis(df.withColumn("threshold", tmap[F.col(model)]), label, prob, F.col("threshold"), by=model)
    rows = per_model.select(
        F.col(model).alias("strategy"),
        F.col("net_profit").alias("profit"),
        F.col("calls_made").alias("calls"),
        F.col("tp").alias("conversions"),
    )
    # Class totals are the same for every model: one row per model, any will do.
    totals = per_model.agg(F.max(F.col("tp") + F.col("fn")).alias("P"), F.max(F.col("fp") + F.col("tn")).alias("N"))
    nobody = totals.select(
        F.lit("call_nobody").alias("strategy"),
        (-(F.col("P") * F.lit(COST_FN)) if charge_missed else F.lit(0.0)).cast("double").alias("profit"),
        F.lit(0).cast("long").alias("calls"),
        F.lit(0).cast("long").alias("conversions"),
    )
    everybody = totals.select(
        F.lit("call_everybody").alias("strategy"),
        (F.col("P") * F.lit(VALUE_TP - COST_FP) - F.col("N") * F.lit(COST_FP)).cast("double").alias("profit"),
        (F.col("P") + F.col("N")).alias("calls"),
        F.col("P").alias("conversions"),
    )
    out = nobody.unionByName(everybody).unionByName(rows)
    return out.withColumn("profit_per_call", _safe_div(F.col("profit"), F.col("calls")))


# ---------------------------------------------------------------------------
# Before / after tuning (inputs: long scores with model and stage columns)
# ---------------------------------------------------------------------------
def stage_costs(
    df: DataFrame,
    thresholds: Mapping[tuple[str, str], float],
    model: str = "model",
    stage: str = "stage",
    label: str = "y",
    prob: str = "probability",
) -> DataFrame:
    """Per (model, stage): TP revenue, FP cost, FN loss and net profit at the
    stage's threshold (``thresholds[(model, stage)]``, a few numbers)."""
    key = F.concat_ws("\u0001", F.col(model), F.col(stage))
    tmap = F.create_map(*[x for (m, s), t in thresholds.items() for x in (F.lit(f"{m}\u0001{s}"), F.lit(float(t)))])
    c = confusion(df.withColumn("_t", tmap[key]), label, prob, F.col("_t"), by=[model, stage])
    return c.select(
        model,
        stage,
        (F.col("tp") * F.lit(VALUE_TP - COST_FP)).alias("tp_revenue"),
        (F.col("fp") * F.lit(COST_FP)).alias("fp_cost"),
        (F.col("fn") * F.lit(COST_FN)).alias("fn_loss"),
        profit_expr(F.col("tp"), F.col("fp"), F.col("fn")).cast("double").alias("net_profit"),
    )


def cost_breakdown(costs: DataFrame, model: str = "model", stage: str = "stage", before: str = "baseline", after: str = "tuned") -> DataFrame:
    """Stage rows plus a ``delta`` row (after - before) per model."""
    vals = ["tp_revenue", "fp_cost", "fn_loss", "net_profit"]
    sign = F.when(F.col(stage) == after, 1.0).when(F.col(stage) == before, -1.0).otherwise(0.0)
    delta = costs.groupBy(model).agg(*[F.sum(F.col(v) * sign).alias(v) for v in vals]).withColumn(stage, F.lit("delta"))
    return costs.unionByName(delta.select(model, stage, *vals))


def profit_stages(stages: DataFrame, model: str = "model", stage: str = "stage", order: Sequence[str] = ("baseline", "tuned", "optimised")) -> DataFrame:
    """One row per model: profit at each stage (pivot) and the gains between them."""
    wide = stages.groupBy(model).pivot(stage, list(order)).agg(F.first("net_profit"))
    a, b, c = order
    return wide.select(
        model,
        a,
        b,
        c,
        (F.col(b) - F.col(a)).alias("gain_tuning"),
        (F.col(c) - F.col(b)).alias("gain_threshold"),
        (F.col(c) - F.col(a)).alias("total_gain"),
    )


def tuning_comparison(before: DataFrame, after: DataFrame, model: str = "model") -> DataFrame:
    """Inner join on model (models missing on either side are skipped):
    AUC, log loss, Brier and profit before/after and the differences."""
    cols = ["roc_auc", "log_loss", "brier_score", "net_profit"]
    b = before.select(model, *[F.col(c).alias(f"{c}_before") for c in cols])
    a = after.select(model, *[F.col(c).alias(f"{c}_after") for c in cols])
    j = b.join(a, model, "inner")
    return j.select(
        "*",
        (F.col("roc_auc_after") - F.col("roc_auc_before")).alias("auc_gain"),
        (F.col("log_loss_before") - F.col("log_loss_after")).alias("log_loss_gain"),
        (F.col("brier_score_before") - F.col("brier_score_after")).alias("brier_gain"),
        (F.col("net_profit_after") - F.col("net_profit_before")).alias("profit_gain"),
    )


def pr_curve(df: DataFrame, label="y", prob="probability", by=None, n_ranges=None) -> DataFrame:
    """Precision and recall at every distinct score."""
    keys = _by(by)
    cum = cumulative_scores(df, label, prob, keys, n_ranges=n_ranges)
    return cum.select(
        *keys,
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        _safe_div(F.col("cum_pos").cast("double"), F.col("pos_total")).alias("recall"),
    )
