"""Lead ranking and segmentation over scored rows.

Ranking uses ``orderBy(...).limit(k)`` (TakeOrderedAndProject: per-task
top-k, then a k-row merge) rather than a global sort.  Segment reports are
one ``groupBy`` over a ``when``-derived segment column; per-segment top
levels use a window over the already aggregated (segment, feature, level)
counts, never over rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.functions.columns import quoted, sanitised
from leadlens.operators.evaluate import BASE_CONVERSION, COST_FN, COST_FP, VALUE_TP, profit_expr, valid_probability

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# ---------------------------------------------------------------------------
ZONE_FLOOR = 0.05  # below: do not call
ZONE_CEILING = 1.01  # upper bound of the call-now zone
ZONE_NAMES = ["DO NOT CALL", "LOW PRIORITY", "CALL NOW"]
HOT_FLOOR = 0.35  # fixed tiers: Hot >= 0.35, Warm >= 0.11, Cold below
WARM_FLOOR = 0.11
TIER_ORDER = ["Hot", "Warm", "Cold"]
TIER_ACTIONS = {"Hot": "Priority call — senior agent", "Warm": "Standard call queue", "Cold": "Email nurture / skip"}
NET_TP = VALUE_TP - COST_FP
TOP_LEADS = 20
PROFILE_TOP = 6


# ---------------------------------------------------------------------------
# Batch scoring
# ---------------------------------------------------------------------------
def probability_of_positive(scored: DataFrame, prob_vector: str = "probability", out: str = "probability") -> DataFrame:
    """MLlib probability vector -> the positive-class probability as a double."""
    from pyspark.ml.functions import vector_to_array

    return scored.withColumn(out, vector_to_array(F.col(prob_vector))[1])


def sanitise_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN / NULL / +-Inf -> 0 and clip to +-1e9 on numeric columns before scoring."""
    from pyspark.sql import types as T

    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.withColumns({c: sanitised(c) for c in cols})


def batch_score(
    df: DataFrame,
    threshold: float,
    prob: str = "probability",
    model=None,
    digits: int = 4,
) -> DataFrame:
    """Score (optionally through a fitted ``PipelineModel``), round the
    probability, decide YES/NO on the UNROUNDED value; highest first.  A NULL or NaN probability fails the job."""
    scored = df
    if model is not None:
        scored = probability_of_positive(model.transform(df), "probability", "_p").drop(
            "rawPrediction", "prediction", "probability", "features"
        )
        prob = "_p"
    p = valid_probability(F.col(prob))
    out = scored.withColumns(
        {"verdict": F.when(p >= F.lit(threshold), "YES").otherwise("NO"), "probability": F.round(p, digits)}
    )
    if prob != "probability":
        out = out.drop(prob)
    # rounded values tie by the thousand: sort by the exact one, then by every other column
    rest = [quoted(c) for c in df.columns if c not in (prob, "probability")]
    exact = scored.withColumns({"_exact": p, "verdict": F.when(p >= F.lit(threshold), "YES").otherwise("NO"), "probability": F.round(p, digits)})
    return exact.orderBy(F.desc("_exact"), *rest).select(*[quoted(c) for c in out.columns])


def batch_summary(df: DataFrame, threshold: float, prob: str = "probability") -> DataFrame:
    """total, yes (call), no (skip), average probability: one row.  A NULL or NaN probability fails the job."""
    p = valid_probability(F.col(prob))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(p >= F.lit(threshold), 1)).alias("n_yes"),
        F.count(F.when(~(p >= F.lit(threshold)), 1)).alias("n_no"),
        F.avg(p).alias("avg_prob"),
    )


def campaign_impact(summary: DataFrame, base_rate: float = BASE_CONVERSION) -> DataFrame:
    """Expected profit of calling the YES rows vs calling everybody, from ``batch_summary``.
    (avg_prob is over ALL rows, as in the reference.)"""
    yes, no, tot, ap = (F.col(c).cast("double") for c in ("n_yes", "n_no", "total", "avg_prob"))
    tp, fp, fn = yes * ap, yes * (F.lit(1.0) - ap), no * F.lit(base_rate)
    ml = tp * F.lit(NET_TP) - fp * F.lit(COST_FP) - fn * F.lit(COST_FN)
    call_all = tot * F.lit(base_rate) * F.lit(NET_TP) - tot * F.lit(1.0 - base_rate) * F.lit(COST_FP)
    return summary.select(
        "total",
        "n_yes",
        "n_no",
        "avg_prob",
        ml.alias("ml_profit"),
        call_all.alias("call_all_profit"),
        (ml - call_all).alias("advantage"),
        F.when(call_all > 0, (ml / call_all - 1) * 100).alias("advantage_pct"),
    )


def top_leads(df: DataFrame, prob: str = "probability", key: str | None = None, n: int = TOP_LEADS) -> DataFrame:
    """Top ``n`` rows by probability (key breaks ties): per-task top-k + merge."""
    order = [F.desc(prob)] + ([F.asc(key)] if key else [])
    return df.orderBy(*order).limit(n)


# ---------------------------------------------------------------------------
# Decision zones
# ---------------------------------------------------------------------------
def zone_column(prob: str | Column, threshold: float, floor: float = ZONE_FLOOR, ceiling: float = ZONE_CEILING) -> Column:
    p = F.col(prob) if isinstance(prob, str) else prob
    return (
        F.when((p >= F.lit(0.0)) & (p < F.lit(floor)), ZONE_NAMES[0])
        .when((p >= F.lit(floor)) & (p < F.lit(float(threshold))), ZONE_NAMES[1])
        .when((p >= F.lit(float(threshold))) & (p < F.lit(ceiling)), ZONE_NAMES[2])
    )


def decision_zones(df: DataFrame, threshold: float, label: str = "y", prob: str = "probability") -> DataFrame:
    """Per zone: rows, subscribers, conversion %, mean p, revenue at risk
    (subscribers x 200), call cost (rows x 5), and calls saved by skipping the
    lower zones.  Empty zones appear with zeros (zone list left-joined)."""
    spark = df.sparkSession
    zones = spark.createDataFrame([(i, z) for i, z in enumerate(ZONE_NAMES)], "zone_order int, zone string")
    g = (
        df.select(zone_column(prob, threshold).alias("zone"), F.col(label).cast("int").alias("_y"), F.col(prob).cast("double").alias("_p"))
        .groupBy("zone")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("subscribers"), F.avg("_p").alias("avg_prob"))
    )
    g = g.where(F.col("zone").isNotNull())  # at most one row per zone
    out = zones.join(F.broadcast(g), "zone", "left").select(
        "zone_order",
        "zone",
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("subscribers", F.lit(0)).cast("long").alias("subscribers"),
        F.when(F.col("n") > 0, F.round(F.col("subscribers") / F.col("n") * 100, 2)).otherwise(F.lit(0.0)).alias("conversion_pct"),
        F.when(F.col("n") > 0, F.round("avg_prob", 4)).otherwise(F.lit(0.0)).alias("avg_prob"),
        (F.coalesce("subscribers", F.lit(0)) * F.lit(int(VALUE_TP))).cast("long").alias("revenue_at_risk"),
        (F.coalesce("n", F.lit(0)) * F.lit(int(COST_FP))).cast("long").alias("call_cost"),
    )
    w = Window.orderBy("zone_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # three rows: a global window over them is bounded
    return out.withColumn("calls_saved_if_skipped", F.sum("n").over(w))


def segment_profile(
    df: DataFrame,
    segment: Column,
    features: Sequence[str],
    label: str = "y",
    top: int = PROFILE_TOP,
    name: str = "segment",
) -> DataFrame:
    """Top ``top`` levels of each feature inside each segment: rows, share of the
    segment (%) and subscribers among them (share of the segment, %)."""
    long = df.select(
        segment.alias(name),
        F.col(label).cast("int").alias("_y"),
        F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), quoted(f).cast("string").alias("level")) for f in features])),
    )
    counts = long.groupBy(name, "feature", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("subs"))
    # a feature may have very many levels: totals and the best levels come from map-side aggregates, first within hash groups of levels
    totals = counts.groupBy(name, "feature").agg(F.sum("n").alias("_seg_n"))
    part = F.pmod(F.xxhash64("level"), F.lit(256)).alias("_part")
    some = Window.partitionBy(name, "feature", part).orderBy(F.desc("n"), F.asc("level"))
    best = counts.withColumn("_place", F.row_number().over(some)).where(F.col("_place") <= top).drop("_place")
    rank = Window.partitionBy(name, "feature").orderBy(F.desc("n"), F.asc("level"))  # at most 256 * top rows
    ranked = best.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top)
    same = [ranked[name].eqNullSafe(totals[name]), ranked["feature"] == totals["feature"]]
    ranked = ranked.join(totals, same).select(ranked[name], ranked["feature"], "rank", "level", "n", "subs", "_seg_n")
    return ranked.select(
        name,
        "feature",
        "rank",
        "level",
        "n",
        (F.col("n") / F.col("_seg_n") * 100).alias("pct_of_segment"),
        F.col("subs").cast("long").alias("subscribers"),
        (F.col("subs") / F.col("_seg_n") * 100).alias("subscriber_pct_of_segment"),
    )


def zone_profile(df: DataFrame, threshold: float, features: Sequence[str], label: str = "y", prob: str = "probability") -> DataFrame:
    return segment_profile(df.where(zone_column(prob, threshold).isNotNull()), zone_column(prob, threshold), features, label, name="zone")


# ---------------------------------------------------------------------------
# Tiers
# ---------------------------------------------------------------------------
def fixed_tier_column(prob: str | Column, hot: float = HOT_FLOOR, warm: float = WARM_FLOOR) -> Column:
    p = F.col(prob) if isinstance(prob, str) else prob
    return F.when(p >= F.lit(hot), "Hot").when(p >= F.lit(warm), "Warm").otherwise("Cold")


def fixed_tiers(df: DataFrame, prob: str = "probability", out: str = "tier") -> DataFrame:
    return df.withColumn(out, fixed_tier_column(prob))


def kmeans_cuts(df: DataFrame, prob: str = "probability", k: int = 3, digits: int = 4) -> list[dict]:
    """The k groups of least squared deviation of the rounded probabilities, exactly: per group its least and greatest value (lo, hi), n and
    centre, ascending.

    In one dimension the groups are ranges, so the best cuts follow from prefix sums of count, sum and squares over the distinct
    rounded values (at most 10**digits + 1, which reach the driver) by dynamic programming; nothing is random.  Of equally
    good cuts the lower ones win; with fewer distinct values than k, each is a group.  A probability that is NULL, NaN or outside [0, 1] fails the job.
    """
    import numpy as np

    p = valid_probability(F.col(prob))
    p = F.when((p >= 0) & (p <= 1), p).otherwise(F.raise_error(F.lit("probability outside [0, 1]")).cast("double"))
    rows = df.groupBy(F.round(p * 10**digits).cast("long").alias("v")).agg(F.count(F.lit(1)).alias("n")).orderBy("v").collect()
    if not rows:
        return []
    v, n = np.array([r["v"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)
    m, k = len(v), min(k, len(v))
    zero = np.zeros(1)
    count, total, squares = (np.concatenate([zero, np.cumsum(x)]) for x in (n.astype(float), (n * v).astype(float), (n * v * v).astype(float)))

    def spread(a, b):
        """Squared deviation of the values a..b-1 from their mean."""
        return (squares[b] - squares[a]) - (total[b] - total[a]) ** 2 / (count[b] - count[a])

    ends = np.arange(1, m + 1)
    best = spread(np.zeros(m, np.int64), ends)  # the first e values in one group
    cuts = []
    for g in range(1, k):
        now, cut = np.full(m, np.inf), np.zeros(m, np.int64)
        for e in range(g + 1, m + 1):
            a = np.arange(g, e)
            cost = best[a - 1] + spread(a, np.full(len(a), e))
            at = int(np.argmin(cost))
            now[e - 1], cut[e - 1] = cost[at], a[at]
        best = now
        cuts.append(cut)
    edges = [m]
    for cut in reversed(cuts):
        edges.append(int(cut[edges[-1] - 1]))
    edges = [0, *reversed(edges)]
    unit = 10**digits
    return [
        {"lo": v[a] / unit, "hi": v[b - 1] / unit, "n": int(count[b] - count[a]), "centre": (total[b] - total[a]) / (count[b] - count[a]) / unit}
        for a, b in zip(edges, edges[1:])
    ]


def kmeans_tiers(df: DataFrame, prob: str = "probability", k: int = 3, out: str = "tier", digits: int = 4) -> DataFrame:
    """``df`` with the tier of its probability: Cold/Warm/Hot (tier_0.. for another k) by ``kmeans_cuts``."""
    groups = kmeans_cuts(df, prob, k, digits)
    names = ["Cold", "Warm", "Hot"] if k == 3 else [f"tier_{r}" for r in range(k)]
    v = F.round(F.col(prob).cast("double") * 10**digits)
    tier = F.lit(None).cast("string")
    for group, name in reversed(list(zip(groups, names))):
        tier = F.when(v <= round(group["hi"] * 10**digits), name).otherwise(tier)
    return df.withColumn(out, tier)


def tier_rules(df: DataFrame, threshold: float, label: str = "y", prob: str = "probability", tier: str = "tier") -> DataFrame:
    """Per tier: rows, subscribers, conversion %, mean/min/max p, net profit at the
    threshold, action and share of all rows.  A NULL or NaN probability fails the job."""
    p = valid_probability(F.col(prob))
    y = F.col(label).cast("int")
    pred = p >= F.lit(float(threshold))
    g = df.groupBy(tier).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y).cast("long").alias("subscribers"),
        F.avg(p).alias("avg_prob"),
        F.min(p).alias("min_prob"),
        F.max(p).alias("max_prob"),
        F.count(F.when(pred & (y == 1), 1)).alias("_tp"),
        F.count(F.when(pred & (y == 0), 1)).alias("_fp"),
        F.count(F.when(~pred & (y == 1), 1)).alias("_fn"),
    )
    actions = F.create_map(*[x for t, a in TIER_ACTIONS.items() for x in (F.lit(t), F.lit(a))])
    w = Window.partitionBy()  # one row per tier: bounded
    return g.select(
        tier,
        "n",
        "subscribers",
        F.round(F.col("subscribers") / F.col("n") * 100, 2).alias("conversion_pct"),
        F.round("avg_prob", 4).alias("avg_prob"),
        "min_prob",
        "max_prob",
        profit_expr(F.col("_tp"), F.col("_fp"), F.col("_fn")).alias("net_profit"),
        actions[F.col(tier)].alias("action"),
        (F.col("n") / F.sum("n").over(w) * 100).alias("share_pct"),
    )


def tier_profile(df: DataFrame, features: Sequence[str], label: str = "y", tier: str = "tier") -> DataFrame:
    return segment_profile(df, F.col(tier), features, label, name="tier")


def tier_economics(rules: DataFrame, tier: str = "tier") -> DataFrame:
    """Conversion %, revenue at risk if the tier is skipped, call cost, TP revenue."""
    return rules.select(
        tier,
        "n",
        "subscribers",
        (F.col("subscribers") / F.col("n") * 100).alias("conversion_pct"),
        (F.col("subscribers") * F.lit(COST_FN)).alias("revenue_at_risk"),
        (F.col("n") * F.lit(COST_FP)).alias("call_cost"),
        (F.col("subscribers") * F.lit(NET_TP)).alias("tp_revenue"),
    )


def top_level(profile: DataFrame, segment: str = "tier") -> DataFrame:
    """The most common level of each feature in each segment."""
    return profile.where(F.col("rank") == 1).select(segment, "feature", "level")

