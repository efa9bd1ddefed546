"""The query catalog: every registered operator bound to the driver tables.

Each query reads whole tables (through the views in ``datasets``); the SQL
twin recomputes the same answer independently in DuckDB — usually by brute
force (rows x thresholds, plain windows), which is the point of an oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.operators import evaluate as ev
from leadlens.operators import profile as pr
from leadlens.plans import datasets as ds
from leadlens.plans.registry import register, sql_double

EPS = ev.LOG_LOSS_EPS
LEADS = f"leads AS ({ds.LEADS_SQL})"
PROSPECTS = f"prospects AS ({ds.PROSPECTS_SQL})"
SCORES = f"scores AS ({ds.MODEL_SCORES_SQL})"


def _grid_sql(n: int, start: float, stop: float) -> str:
    """numpy linspace in SQL: i*step + start, last point = stop."""
    s, e = sql_double(start), sql_double(stop)
    return (
        f"SELECT CASE WHEN i = {n - 1} THEN {e} ELSE CAST(i AS DOUBLE) * (({e} - {s}) / {n - 1}.0) + {s} END AS t "
        f"FROM range({n}) r(i)"
    )


def _values_sql(xs) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"({sql_double(x)})" for x in xs) + ") v(t)"


def _conf_sql(pred: str) -> str:
    return (
        f"count(*) FILTER (WHERE y = 0 AND NOT ({pred})) AS tn, "
        f"count(*) FILTER (WHERE y = 0 AND ({pred})) AS fp, "
        f"count(*) FILTER (WHERE y = 1 AND NOT ({pred})) AS fn, "
        f"count(*) FILTER (WHERE y = 1 AND ({pred})) AS tp"
    )


def _metrics_sql(tp="tp", fp="fp", fn="fn", tn="tn") -> str:
    d = lambda x: f"CAST({x} AS DOUBLE)"
    TP, FP, FN, TN = d(tp), d(fp), d(fn), d(tn)
    return (
        f"CASE WHEN {TP}+{TN}+{FP}+{FN} > 0 THEN ({TP}+{TN})/({TP}+{TN}+{FP}+{FN}) ELSE 0.0 END AS accuracy, "
        f"CASE WHEN {TP}+{FP} > 0 THEN {TP}/({TP}+{FP}) ELSE 0.0 END AS precision, "
        f"CASE WHEN {TP}+{FN} > 0 THEN {TP}/({TP}+{FN}) ELSE 0.0 END AS recall, "
        f"CASE WHEN 2*{TP}+{FP}+{FN} > 0 THEN 2*{TP}/(2*{TP}+{FP}+{FN}) ELSE 0.0 END AS f1, "
        f"CASE WHEN ({TP}+{FP})*({TP}+{FN})*({TN}+{FP})*({TN}+{FN}) > 0 "
        f"THEN ({TP}*{TN}-{FP}*{FN})/sqrt(({TP}+{FP})*({TP}+{FN})*({TN}+{FP})*({TN}+{FN})) ELSE 0.0 END AS mcc"
    )


def _profit_sql(tp="tp", fp="fp", fn="fn") -> str:
    return f"CAST({tp} * 195 - {fp} * 5 - {fn} * 200 AS DOUBLE)"


def _rank_sql(src: str, keys: str = "") -> str:
    """Per-group ROC-AUC and average precision by plain windows over distinct scores."""
    kp = f"PARTITION BY {keys}" if keys else ""
    kg = f"{keys}, " if keys else ""
    return f"""
    d AS (SELECT {kg}score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
          FROM {src} GROUP BY {kg}score),
    c AS (SELECT *, sum(pos) OVER ({kp} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
                    sum(neg) OVER ({kp} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
                    sum(pos) OVER ({kp}) AS P, sum(neg) OVER ({kp}) AS N FROM d),
    r AS (SELECT {kg}CASE WHEN max(P) * max(N) > 0 THEN CAST(sum(pos * (2 * (N - cum_neg) + neg)) AS DOUBLE)
                 / (2.0 * (CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE))) END AS roc_auc,
                 CASE WHEN max(P) > 0 THEN sum(pos * (cum_pos / (cum_pos + cum_neg))) / max(P) END AS pr_auc
          FROM c {"GROUP BY " + keys if keys else ""})"""


def _pc(col: str) -> str:
    return f"greatest(least({col}, {sql_double(1.0 - EPS)}), {sql_double(EPS)})"


# ===========================================================================
# 2.8 Evaluation and dollars (scores: the stand-in model on lineitem)
# ===========================================================================
@register(
    "confusion",
    f"WITH {LEADS} SELECT {_conf_sql('score >= 0.5')} FROM leads",
)
def q_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion(ds.leads(spark, sf), "y", "score", 0.5)


@register(
    "compute_metrics",
    f"""WITH {LEADS},
    m AS (SELECT {_conf_sql('score >= 0.5')},
                 avg(CASE WHEN y = 1 THEN -ln({_pc('score')}) ELSE -ln(1.0 - {_pc('score')}) END) AS log_loss,
                 avg((score - y) * (score - y)) AS brier_score FROM leads),
    {_rank_sql('leads')}
    SELECT {_metrics_sql()}, roc_auc, pr_auc, log_loss, brier_score FROM m, r""",
)
def q_compute_metrics(spark, sf):
    return ev.compute_metrics(ds.leads(spark, sf), "y", "score", threshold=0.5)


@register("roc_auc", f"WITH {LEADS}, {_rank_sql('leads')} SELECT roc_auc FROM r")
def q_roc_auc(spark, sf):
    return ev.roc_auc(ds.leads(spark, sf), "y", "score")


@register("pr_auc", f"WITH {LEADS}, {_rank_sql('leads')} SELECT pr_auc FROM r")
def q_pr_auc(spark, sf):
    return ev.pr_auc(ds.leads(spark, sf), "y", "score")


@register(
    "log_loss",
    f"WITH {LEADS} SELECT avg(CASE WHEN y = 1 THEN -ln({_pc('score')}) ELSE -ln(1.0 - {_pc('score')}) END) AS log_loss FROM leads",
)
def q_log_loss(spark, sf):
    return ev.log_loss(ds.leads(spark, sf), "y", "score")


@register(
    "mcc_brier",
    f"""WITH {LEADS}, c AS (SELECT {_conf_sql('score >= 0.5')}, avg((score - y) * (score - y)) AS brier_score FROM leads)
    SELECT CASE WHEN (CAST(tp AS DOUBLE)+fp)*(CAST(tp AS DOUBLE)+fn)*(CAST(tn AS DOUBLE)+fp)*(CAST(tn AS DOUBLE)+fn) > 0
           THEN (CAST(tp AS DOUBLE)*tn - CAST(fp AS DOUBLE)*fn) /
                sqrt((CAST(tp AS DOUBLE)+fp)*(CAST(tp AS DOUBLE)+fn)*(CAST(tn AS DOUBLE)+fp)*(CAST(tn AS DOUBLE)+fn))
           ELSE 0.0 END AS mcc, brier_score FROM c""",
)
def q_mcc_brier(spark, sf):
    return ev.compute_metrics(ds.leads(spark, sf), "y", "score", 0.5).select("mcc", "brier_score")


@register(
    "roc_curve",
    f"""WITH {LEADS}, {_rank_sql('leads')}
    SELECT score AS threshold, CAST(cum_pos AS BIGINT) AS tp, CAST(cum_neg AS BIGINT) AS fp,
           CASE WHEN N > 0 THEN CAST(cum_neg AS DOUBLE) / N ELSE 0.0 END AS fpr,
           CASE WHEN P > 0 THEN CAST(cum_pos AS DOUBLE) / P ELSE 0.0 END AS tpr,
           CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg) AS precision FROM c""",
)
def q_roc_curve(spark, sf):
    return ev.roc_curve(ds.leads(spark, sf), "y", "score")


@register(
    "classification_report",
    f"""WITH {LEADS}, c AS (SELECT {_conf_sql('score >= 0.5')} FROM leads),
    v AS (SELECT CAST(tp AS DOUBLE) tp, CAST(fp AS DOUBLE) fp, CAST(fn AS DOUBLE) fn, CAST(tn AS DOUBLE) tn FROM c),
    k AS (SELECT *, CASE WHEN tp+fp > 0 THEN tp/(tp+fp) ELSE 0.0 END p1, CASE WHEN tp+fn > 0 THEN tp/(tp+fn) ELSE 0.0 END r1,
                 CASE WHEN tn+fn > 0 THEN tn/(tn+fn) ELSE 0.0 END p0, CASE WHEN tn+fp > 0 THEN tn/(tn+fp) ELSE 0.0 END r0,
                 tp+fn s1, tn+fp s0, tp+fp+fn+tn n FROM v),
    f AS (SELECT *, CASE WHEN p1+r1 > 0 THEN 2*p1*r1/(p1+r1) ELSE 0.0 END f1_1,
                 CASE WHEN p0+r0 > 0 THEN 2*p0*r0/(p0+r0) ELSE 0.0 END f1_0,
                 CASE WHEN n > 0 THEN (tp+tn)/n ELSE 0.0 END acc FROM k)
    SELECT '0' AS class, p0 AS precision, r0 AS recall, f1_0 AS f1, s0 AS support FROM f
    UNION ALL SELECT '1', p1, r1, f1_1, s1 FROM f
    UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM f
    UNION ALL SELECT 'macro avg', (p0+p1)/2, (r0+r1)/2, (f1_0+f1_1)/2, n FROM f
    UNION ALL SELECT 'weighted avg', CASE WHEN n > 0 THEN (p0*s0+p1*s1)/n ELSE 0.0 END,
                     CASE WHEN n > 0 THEN (r0*s0+r1*s1)/n ELSE 0.0 END,
                     CASE WHEN n > 0 THEN (f1_0*s0+f1_1*s1)/n ELSE 0.0 END, n FROM f""",
)
def q_classification_report(spark, sf):
    return ev.classification_report(ds.leads(spark, sf), "y", "score", 0.5)


def _sweep_sql(grid: str, src: str = "leads", keys: str = "") -> str:
    kg = f"{keys}, " if keys else ""
    return f"""g AS ({grid}),
    sw AS (SELECT {kg}t AS threshold,
                  count(*) FILTER (WHERE y = 1 AND score >= t) AS tp,
                  count(*) FILTER (WHERE y = 0 AND score >= t) AS fp,
                  count(*) FILTER (WHERE y = 1 AND score < t) AS fn,
                  count(*) FILTER (WHERE y = 0 AND score < t) AS tn
           FROM {src}, g GROUP BY {kg}t)"""


@register(
    "find_optimal_threshold",
    f"""WITH {LEADS}, {_sweep_sql(_grid_sql(200, 0.05, 0.95))}
    SELECT threshold, {_profit_sql()} AS net_profit FROM sw
    ORDER BY net_profit DESC, threshold ASC LIMIT 1""",
)
def q_find_optimal_threshold(spark, sf):
    return ev.find_optimal_threshold(ds.leads(spark, sf), "y", "score")


@register(
    "profit_curve",
    f"""WITH {LEADS}, {_sweep_sql(_grid_sql(100, 0.05, 0.95))}
    SELECT threshold, tp, fp, fn, tn, {_profit_sql()} AS net_profit,
           CASE WHEN tp+fn > 0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0.0 END AS recall,
           CASE WHEN tp+fp > 0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0.0 END AS precision,
           CASE WHEN fp+tn > 0 THEN CAST(fp AS DOUBLE)/(fp+tn) ELSE 0.0 END AS fpr FROM sw""",
)
def q_profit_curve(spark, sf):
    return ev.profit_curve(ds.leads(spark, sf), "y", "score", n_steps=100)


@register(
    "recall_analysis",
    f"""WITH {LEADS}, {_sweep_sql(_values_sql(ev.arange(0.05, 0.95, 0.05)))}
    SELECT round(threshold, 2) AS threshold,
           round(CASE WHEN tp+fn > 0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0.0 END, 3) AS recall,
           round(CASE WHEN tp+fp > 0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0.0 END, 3) AS precision,
           tp + fp AS calls_made, tp AS subscribers_caught, fn AS subscribers_missed, fp AS false_alarms,
           round({_profit_sql()}, 0) AS net_profit, round(CAST(fn * 640 AS DOUBLE), 0) AS missed_nim_revenue FROM sw""",
)
def q_recall_analysis(spark, sf):
    return ev.recall_analysis(ds.leads(spark, sf), "y", "score")


def _bca_sql(pred: str, src: str = "leads", keys: str = "") -> str:
    kg = f"{keys}, " if keys else ""
    return f"""c AS (SELECT {kg}{_conf_sql(pred)} FROM {src} {"GROUP BY " + keys if keys else ""})
    SELECT {kg}tp, fp, fn, tn, CAST(tp * 195 AS DOUBLE) AS revenue, CAST(fp * 5 AS DOUBLE) AS wasted_cost,
           CAST(fn * 200 AS DOUBLE) AS missed_opportunity, {_profit_sql()} AS net_profit,
           CASE WHEN tp+fp+fn+tn > 0 THEN {_profit_sql()} / (tp+fp+fn+tn) ELSE 0.0 END AS profit_per_client,
           tp + fp AS calls_made, tp + fp + fn + tn AS total_clients, tp AS subscribers_found, fn AS subscribers_missed,
           CASE WHEN tp+fn > 0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0.0 END AS catch_rate,
           CASE WHEN tp+fp > 0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0.0 END AS call_efficiency,
           CAST(fn * 640 AS DOUBLE) AS missed_annual_nim, CAST(fn * 1280 AS DOUBLE) AS missed_lifetime_nim FROM c"""


@register("business_cost_analysis", f"WITH {LEADS}, {_bca_sql('score >= 0.3')}")
def q_business_cost_analysis(spark, sf):
    return ev.business_cost_analysis(ds.leads(spark, sf), "y", "score", 0.3)


# ---------------------------------------------------------------------------
# Per-model comparisons (four stand-in models, baseline and tuned stages)
# ---------------------------------------------------------------------------
def _opt_sql(src: str) -> str:
    """Optimal threshold per model on the 200-point grid (brute force)."""
    return f"""{_sweep_sql(_grid_sql(200, 0.05, 0.95), src, "model")},
    opt AS (SELECT model, threshold, net_profit FROM (
        SELECT model, threshold, {_profit_sql()} AS net_profit,
               row_number() OVER (PARTITION BY model ORDER BY {_profit_sql()} DESC, threshold ASC) AS rn FROM sw) WHERE rn = 1)"""


def _comparison_sql() -> str:
    return f"""{SCORES}, tuned AS (SELECT * FROM scores WHERE stage = 'tuned'),
    {_opt_sql('tuned')},
    ts AS (SELECT s.*, o.threshold FROM tuned s JOIN opt o USING (model)),
    m AS (SELECT model, {_conf_sql('score >= threshold')},
                 avg(CASE WHEN y = 1 THEN -ln({_pc('score')}) ELSE -ln(1.0 - {_pc('score')}) END) AS log_loss,
                 avg((score - y) * (score - y)) AS brier_score FROM ts GROUP BY model),
    {_rank_sql('tuned', 'model')},
    cmp AS (SELECT m.model, o.threshold, {_metrics_sql()}, r.roc_auc, r.pr_auc, m.log_loss, m.brier_score,
                   o.net_profit, tp, fp, fn, tn
            FROM m JOIN r USING (model) JOIN opt o USING (model))"""


def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    tuned = ds.model_scores(spark, sf, ("tuned",))
    return ev.model_comparison(tuned, "model", "y", "score")


@register("model_comparison", f"WITH {_comparison_sql()} SELECT * FROM cmp")
def q_model_comparison(spark, sf):
    return model_comparison(spark, sf)


@register(
    "select_best_model",
    f"WITH {_comparison_sql()} SELECT * FROM cmp ORDER BY net_profit DESC, model ASC LIMIT 1",
)
def q_select_best_model(spark, sf):
    return ev.select_best_model(model_comparison(spark, sf))


def _best_sql() -> str:
    parts = []
    for k, hi in ev.CRITERIA.items():
        sign = "1.0" if hi else "-1.0"
        parts.append(f"SELECT model, '{k}' AS criterion, CAST({k} AS DOUBLE) AS value, CAST({k} AS DOUBLE) * {sign} AS s FROM cmp")
    return " UNION ALL ".join(parts)


@register(
    "best_per_criterion",
    f"""WITH {_comparison_sql()}, lng AS ({_best_sql()})
    SELECT criterion, model AS winner, value FROM (
      SELECT *, row_number() OVER (PARTITION BY criterion ORDER BY s DESC, model ASC) AS rn FROM lng) WHERE rn = 1""",
)
def q_best_per_criterion(spark, sf):
    return ev.best_per_criterion(model_comparison(spark, sf))


@register(
    "strategy_compare",
    f"""WITH {SCORES}, tuned AS (SELECT * FROM scores WHERE stage = 'tuned'), {_opt_sql('tuned')},
    ts AS (SELECT s.*, o.threshold FROM tuned s JOIN opt o USING (model)),
    pm AS (SELECT model, {_conf_sql('score >= threshold')} FROM ts GROUP BY model),
    tot AS (SELECT max(tp + fn) AS P, max(fp + tn) AS N FROM pm),
    u AS (SELECT 'call_nobody' AS strategy, 0.0 AS profit, CAST(0 AS BIGINT) AS calls, CAST(0 AS BIGINT) AS conversions FROM tot
          UNION ALL SELECT 'call_everybody', CAST(P * 195 - N * 5 AS DOUBLE), P + N, P FROM tot
          UNION ALL SELECT model, {_profit_sql()}, tp + fp, tp FROM pm)
    SELECT strategy, CAST(profit AS DOUBLE) AS profit, calls, conversions,
           CASE WHEN calls > 0 THEN CAST(profit AS DOUBLE) / calls ELSE 0.0 END AS profit_per_call FROM u""",
)
def q_strategy_compare(spark, sf):
    tuned = ds.model_scores(spark, sf, ("tuned",))
    th = {r["model"]: r["threshold"] for r in ev.find_optimal_threshold(tuned, "y", "score", by="model").collect()}
    return ev.strategy_compare(tuned, th, "model", "y", "score")


# ===========================================================================
# 2.3 Profile
# ===========================================================================
@register(
    "conversion_by_category",
    f"""WITH {LEADS}, b AS (SELECT avg(CAST(y AS DOUBLE)) * 100 AS base FROM leads)
    SELECT month AS level, avg(CAST(y AS DOUBLE)) * 100 AS conversion_pct, count(*) AS n,
           avg(CAST(y AS DOUBLE)) * 100 / max(base) AS lift,
           avg(CAST(y AS DOUBLE)) * 100 > max(base) AS above_base,
           avg(CAST(y AS DOUBLE)) * 100 > max(base) * CAST('1.3' AS DOUBLE) AS above_mark
    FROM leads, b GROUP BY month""",
)
def q_conversion_by_category(spark, sf):
    return pr.conversion_by_category(ds.leads(spark, sf), "month", "y")


LEAD_NUMS = ["quantity", "price", "discount", "tax"]
PROSPECT_CATS = ["priority", "month", "day_of_week", "status_code"]


def _q_sql(col: str, p: float, src: str) -> str:
    return f"(SELECT quantile_cont({col}, {sql_double(p)}) FROM {src} WHERE {col} IS NOT NULL AND NOT isnan({col}))"


@register(
    "null_report",
    "WITH " + PROSPECTS + ", rep AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c == 'amount' else ''}) AS null_count, "
        f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c == 'amount' else ''}) / count(*) * 100 AS null_pct FROM prospects"
        for c in ["prospect_id", "cust_id", "y", "priority", "month", "day_of_week", "status_code", "amount", "pdays", "previous", "year"]
    )
    + ") SELECT * FROM rep WHERE null_count > 0",
)
def q_null_report(spark, sf):
    return pr.null_report(ds.prospects(spark, sf))


def _unknown_sql() -> str:
    parts = []
    for c in PROSPECT_CATS:
        strat = "impute_mode" if c in ("priority", "month") else ("keep_as_category" if c == "status_code" else "none")
        parts.append(
            f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} = 'unknown') AS unknown_count, "
            f"count(*) FILTER (WHERE {c} = 'unknown') / count(*) * 100 AS unknown_pct, "
            f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_levels, '{strat}' AS strategy FROM prospects"
        )
    return " UNION ALL ".join(parts)


@register("unknown_report", f"WITH {PROSPECTS} {_unknown_sql()}")
def q_unknown_report(spark, sf):
    return pr.unknown_report(ds.prospects(spark, sf), PROSPECT_CATS, impute=["priority", "month"], keep=["status_code"])


def _cooc_sql() -> str:
    parts = []
    cols = PROSPECT_CATS
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            a, b = cols[i], cols[j]
            parts.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr(CASE WHEN {a} = 'unknown' THEN 1.0 ELSE 0.0 END, "
                         f"CASE WHEN {b} = 'unknown' THEN 1.0 ELSE 0.0 END) AS r FROM prospects")
    return " UNION ALL ".join(parts)


@register("unknown_cooccurrence", f"WITH {PROSPECTS}, x AS ({_cooc_sql()}) SELECT column_a, column_b, CASE WHEN isnan(r) THEN NULL ELSE r END AS r FROM x")
def q_unknown_cooccurrence(spark, sf):
    return pr.unknown_cooccurrence(ds.prospects(spark, sf), PROSPECT_CATS)


def _card_sql() -> str:
    parts = []
    for c in PROSPECT_CATS:
        parts.append(
            f"SELECT '{c}' AS column, count(*) AS n_levels, min(n) AS min_count, "
            f"arg_min(v, (n, v)) AS rarest_level, min(n) < 50 AS rare FROM "
            f"(SELECT {c} AS v, count(*) AS n FROM prospects WHERE {c} IS NOT NULL GROUP BY {c})"
        )
    return " UNION ALL ".join(parts)


@register("cardinality_report", f"WITH {PROSPECTS} {_card_sql()}")
def q_cardinality_report(spark, sf):
    return pr.cardinality_report(ds.prospects(spark, sf), PROSPECT_CATS)


def _describe_sql() -> str:
    parts = []
    for c in LEAD_NUMS:
        parts.append(
            f"SELECT '{c}' AS column, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, "
            f"quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q75, "
            f"max({c}) AS max, skewness({c}) AS skewness, kurtosis({c}) AS kurtosis FROM leads"
        )
    return " UNION ALL ".join(parts)


@register("describe", f"WITH {LEADS} {_describe_sql()}")
def q_describe(spark, sf):
    return pr.describe(ds.leads(spark, sf), LEAD_NUMS)


@register(
    "skewness_report",
    f"WITH {LEADS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, skewness({c}) AS skewness, kurtosis({c}) AS kurtosis, "
        f"CASE WHEN abs(skewness({c})) > 2 THEN 'HIGH' ELSE 'OK' END AS flag FROM leads"
        for c in LEAD_NUMS + ["linenumber"]
    ),
)
def q_skewness_report(spark, sf):
    return pr.skewness_report(ds.leads(spark, sf), LEAD_NUMS + ["linenumber"])


CORR_COLS = ["quantity", "price", "discount", "tax", "net_price", "y"]


@register(
    "correlation_matrix",
    f"WITH {LEADS} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {'CAST(max(1.0) AS DOUBLE)' if a == b else f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))'} AS r FROM leads"
        for a in CORR_COLS
        for b in CORR_COLS
    ),
)
def q_correlation_matrix(spark, sf):
    return pr.correlation_matrix(ds.leads(spark, sf), CORR_COLS)


@register(
    "correlation_pairs",
    f"WITH {LEADS}, x AS ("
    + " UNION ALL ".join(
        f"SELECT '{CORR_COLS[i]}' AS column_a, '{CORR_COLS[j]}' AS column_b, abs(corr(CAST({CORR_COLS[i]} AS DOUBLE), CAST({CORR_COLS[j]} AS DOUBLE))) AS abs_r FROM leads"
        for i in range(len(CORR_COLS))
        for j in range(i + 1, len(CORR_COLS))
    )
    + ") SELECT * FROM x WHERE abs_r > 0.7",
)
def q_correlation_pairs(spark, sf):
    return pr.correlation_pairs(ds.leads(spark, sf), CORR_COLS, threshold=0.7)


PB_COLS = ["amount", "pdays", "previous"]


@register(
    "point_biserial",
    f"WITH {PROSPECTS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, abs(corr(CASE WHEN {c} IS NULL OR isnan({c}) THEN {_q_sql(c, 0.5, 'prospects')} ELSE CAST({c} AS DOUBLE) END, "
        f"CAST(y AS DOUBLE))) AS abs_r FROM prospects"
        for c in PB_COLS
    ),
)
def q_point_biserial(spark, sf):
    return pr.point_biserial(ds.prospects(spark, sf), PB_COLS, "y")


OVERVIEW_COLS = ["y", "status", "month", "day_of_week", "linenumber", "quantity", "discount", "tax"]


@register(
    "dataset_overview",
    f"""WITH {LEADS}, v AS (SELECT {', '.join(OVERVIEW_COLS)} FROM leads)
    SELECT (SELECT count(*) FROM v) AS raw_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM v)) AS dedup_rows,
           (SELECT count(*) FROM v) - (SELECT count(*) FROM (SELECT DISTINCT * FROM v)) AS duplicates_removed,
           {len(OVERVIEW_COLS)} AS n_columns, (SELECT avg(CAST(y AS DOUBLE)) FROM v) AS positive_rate""",
)
def q_dataset_overview(spark, sf):
    return pr.dataset_overview(ds.leads(spark, sf).select(*OVERVIEW_COLS), "y")


@register(
    "class_balance",
    f"WITH {LEADS} SELECT y, count(*) AS n, count(*) / sum(count(*)) OVER () * 100 AS pct FROM leads GROUP BY y",
)
def q_class_balance(spark, sf):
    return pr.class_balance(ds.leads(spark, sf), "y")


@register(
    "value_counts_topn",
    f"""WITH {LEADS} SELECT month AS value, count(*) AS n, count(*) / CAST((SELECT count(*) FROM leads) AS DOUBLE) AS share
    FROM leads GROUP BY month ORDER BY n DESC, value ASC LIMIT 5""",
)
def q_value_counts_topn(spark, sf):
    return pr.value_counts_topn(ds.leads(spark, sf), "month", 5)


def _outlier_sql() -> str:
    parts = []
    for c in LEAD_NUMS:
        lo, hi = _q_sql(c, 0.01, "leads"), _q_sql(c, 0.99, "leads")
        parts.append(
            f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} < {lo}) AS n_low, count(*) FILTER (WHERE {c} > {hi}) AS n_high, "
            f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS n_outliers, "
            f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) / count(*) * 100 AS pct, "
            f"{lo} AS low_bound, {hi} AS high_bound FROM leads"
        )
    return " UNION ALL ".join(parts)


@register("outlier_report", f"WITH {LEADS}, x AS ({_outlier_sql()}) SELECT * FROM x WHERE n_outliers > 0")
def q_outlier_report(spark, sf):
    return pr.outlier_report(ds.leads(spark, sf), LEAD_NUMS)


def _calendar_sql(levels) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"({i + 1}, '{v}')" for i, v in enumerate(levels)) + ") c(ordinal, level)"


@register(
    "conversion_by_ordered",
    f"""WITH {PROSPECTS}, cal AS ({_calendar_sql(['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'])}),
    g AS (SELECT month AS level, avg(CAST(y AS DOUBLE)) * 100 AS conversion_pct, count(*) AS n FROM prospects GROUP BY month)
    SELECT CAST(ordinal AS INTEGER) AS ordinal, level, conversion_pct, n FROM cal LEFT JOIN g USING (level)""",
)
def q_conversion_by_ordered(spark, sf):
    return pr.conversion_by_ordered(ds.prospects(spark, sf), "month")


@register(
    "conversion_by_weekday",
    f"""WITH {LEADS}, cal AS ({_calendar_sql(['mon', 'tue', 'wed', 'thu', 'fri', 'sat', 'sun'])}),
    g AS (SELECT day_of_week AS level, avg(CAST(y AS DOUBLE)) * 100 AS conversion_pct, count(*) AS n FROM leads GROUP BY day_of_week)
    SELECT CAST(ordinal AS INTEGER) AS ordinal, level, conversion_pct, n FROM cal LEFT JOIN g USING (level)""",
)
def q_conversion_by_weekday(spark, sf):
    return pr.conversion_by_ordered(ds.leads(spark, sf), "day_of_week")


PDAYS_EDGES = [0, 3, 7, 14, 30, 999]


def _cut_sql(col: str, edges) -> str:
    whens = " ".join(
        f"WHEN {col} > {sql_double(float(edges[i]))} AND {col} <= {sql_double(float(edges[i + 1]))} THEN {i + 1}"
        for i in range(len(edges) - 1)
    )
    return f"CASE {whens} END"


@register(
    "conversion_by_bin",
    f"WITH {PROSPECTS} SELECT {_cut_sql('pdays', PDAYS_EDGES)} AS bin, avg(CAST(y AS DOUBLE)) * 100 AS conversion_pct, "
    f"count(*) AS n FROM prospects GROUP BY 1",
)
def q_conversion_by_bin(spark, sf):
    from leadlens.functions.columns import cut_bins

    return pr.conversion_by_bin(ds.prospects(spark, sf), cut_bins("pdays", PDAYS_EDGES), "y", "bin")


@register(
    "conversion_by_sentinel",
    f"WITH {PROSPECTS} SELECT pdays = 999 AS is_sentinel, avg(CAST(y AS DOUBLE)) * 100 AS conversion_pct, count(*) AS n "
    f"FROM prospects GROUP BY 1",
)
def q_conversion_by_sentinel(spark, sf):
    return pr.conversion_by_sentinel(ds.prospects(spark, sf), "pdays", 999, "y")


def _ew_sql(col: str, n: int, src: str) -> str:
    step = f"((mx - mn) / {n}.0)"
    terms = " + ".join(f"CASE WHEN {col} > {i}.0 * {step} + mn THEN 1 ELSE 0 END" for i in range(1, n))
    return f"(SELECT *, CASE WHEN {col} IS NOT NULL AND NOT isnan({col}) THEN 1 + {terms} END AS bin FROM {src}, " \
           f"(SELECT min({col}) FILTER (WHERE NOT isnan({col})) AS mn, max({col}) FILTER (WHERE NOT isnan({col})) AS mx FROM {src}))"


@register(
    "equal_width_bins",
    f"WITH {LEADS} SELECT CAST(bin AS INTEGER) AS bin, avg(CAST(y AS DOUBLE)) * 100 AS conversion_pct, count(*) AS n "
    f"FROM {_ew_sql('price', 10, 'leads')} GROUP BY bin",
)
def q_equal_width_bins(spark, sf):
    b = pr.equal_width_bins(ds.leads(spark, sf), "price", 10, "bin")
    return pr.conversion_by_bin(b, "bin", "y", "bin")


@register(
    "histogram",
    f"""WITH {LEADS}, e AS (SELECT CAST(i AS INTEGER) AS bin,
        CAST(i AS DOUBLE) * ((CAST('1.0' AS DOUBLE) - CAST('0.0' AS DOUBLE)) / 50.0) + CAST('0.0' AS DOUBLE) AS lower,
        CASE WHEN i = 49 THEN CAST('1.0' AS DOUBLE) ELSE CAST(i + 1 AS DOUBLE) * (1.0 / 50.0) END AS upper FROM range(50) r(i))
    SELECT bin, lower, upper, count(score) AS n FROM e LEFT JOIN leads
      ON score >= lower AND (score < upper OR (bin = 49 AND score <= upper)) GROUP BY bin, lower, upper""",
)
def q_histogram(spark, sf):
    return pr.histogram(ds.leads(spark, sf), "score", 0.0, 1.0, 50)


# ===========================================================================
# 2.4 Cleaning
# ===========================================================================
DEDUP_COLS = OVERVIEW_COLS


@register("dedup_rows", f"WITH {LEADS} SELECT DISTINCT {', '.join(DEDUP_COLS)} FROM leads")
def q_dedup_rows(spark, sf):
    from leadlens.operators.clean import dedup_rows

    return dedup_rows(ds.leads(spark, sf).select(*DEDUP_COLS))


def _clip_sql(c: str, src: str) -> str:
    lo, hi = _q_sql(c, 0.01, src), _q_sql(c, 0.99, src)
    x = f"CAST({c} AS DOUBLE)"
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {x} ELSE least(greatest({x}, {lo}), {hi}) END"


@register(
    "clip_outliers",
    f"WITH {LEADS} SELECT lead_id, " + ", ".join(f"{_clip_sql(c, 'leads')} AS {c}" for c in LEAD_NUMS) + " FROM leads",
)
def q_clip_outliers(spark, sf):
    from leadlens.operators.clean import clip_outliers

    return clip_outliers(ds.leads(spark, sf).select("lead_id", *LEAD_NUMS), LEAD_NUMS)


def _mode_sql(c: str, src: str) -> str:
    return (
        f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL AND {c} <> 'unknown' GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} ASC LIMIT 1)"
    )


@register(
    "impute_mode",
    f"WITH {PROSPECTS} SELECT prospect_id, "
    + ", ".join(f"CASE WHEN {c} = 'unknown' THEN {_mode_sql(c, 'prospects')} ELSE {c} END AS {c}" for c in ("priority", "month"))
    + ", status_code FROM prospects",
)
def q_impute_mode(spark, sf):
    from leadlens.operators.clean import impute_mode

    return impute_mode(ds.prospects(spark, sf).select("prospect_id", "priority", "month", "status_code"), ["priority", "month"])


@register(
    "drop_nulls",
    f"WITH {PROSPECTS} SELECT prospect_id, amount, y FROM prospects WHERE amount IS NOT NULL AND NOT isnan(amount)",
)
def q_drop_nulls(spark, sf):
    from leadlens.operators.clean import drop_nulls

    return drop_nulls(ds.prospects(spark, sf).select("prospect_id", "amount", "y"), ["amount"])


@register("keep_unknown", f"WITH {PROSPECTS} SELECT prospect_id, status_code FROM prospects")
def q_keep_unknown(spark, sf):
    from leadlens.operators.clean import keep_unknown

    return keep_unknown(ds.prospects(spark, sf).select("prospect_id", "status_code"), ["status_code"])


@register(
    "drop_leakage",
    f"WITH {PROSPECTS} SELECT * EXCLUDE (amount) FROM prospects",
)
def q_drop_leakage(spark, sf):
    from leadlens.operators.clean import drop_leakage

    return drop_leakage(ds.prospects(spark, sf), ["amount", "duration"])


CLEAN_CLIP = ["amount", "pdays", "previous"]


@register(
    "clean_data",
    f"""WITH {PROSPECTS}, d AS (SELECT DISTINCT * EXCLUDE (year) FROM prospects),
    c AS (SELECT * REPLACE ({', '.join(f'{_clip_sql(x, "d")} AS {x}' for x in CLEAN_CLIP)}) FROM d)
    SELECT * REPLACE ({', '.join(f"CASE WHEN {x} = 'unknown' THEN {_mode_sql(x, 'c')} ELSE {x} END AS {x}" for x in ('priority', 'month'))})
    FROM c""",
)
def q_clean_data(spark, sf):
    from leadlens.operators.clean import clean_data

    return clean_data(ds.prospects(spark, sf), production=True, leakage=["year"], outlier_cols=CLEAN_CLIP, impute_cols=["priority", "month"])


# ===========================================================================
# 2.9 Lead ranking and segmentation (stand-in probability = leads.score)
# ===========================================================================
CALL_T = 0.30
SCORED = "scored AS (SELECT *, score AS probability FROM leads)"


def _scored(spark, sf) -> DataFrame:
    return ds.leads(spark, sf).withColumn("probability", F.col("score"))


@register(
    "batch_score",
    f"WITH {LEADS} SELECT lead_id, round(score, 4) AS probability, CASE WHEN score >= {sql_double(CALL_T)} THEN 'YES' ELSE 'NO' END AS verdict FROM leads",
)
def q_batch_score(spark, sf):
    from leadlens.operators.leads import batch_score

    return batch_score(_scored(spark, sf).select("lead_id", "probability"), CALL_T)


_SUMMARY_SQL = f"""SELECT count(*) AS total, count(*) FILTER (WHERE score >= {sql_double(CALL_T)}) AS n_yes,
    count(*) FILTER (WHERE NOT (score >= {sql_double(CALL_T)})) AS n_no, avg(score) AS avg_prob FROM leads"""


@register("batch_summary", f"WITH {LEADS} {_SUMMARY_SQL}")
def q_batch_summary(spark, sf):
    from leadlens.operators.leads import batch_summary

    return batch_summary(_scored(spark, sf), CALL_T)


@register(
    "campaign_impact",
    f"""WITH {LEADS}, s AS ({_SUMMARY_SQL}),
    v AS (SELECT *, CAST(n_yes AS DOUBLE) * avg_prob AS tp, CAST(n_yes AS DOUBLE) * (1.0 - avg_prob) AS fp,
                 CAST(n_no AS DOUBLE) * {sql_double(0.113)} AS fn FROM s),
    m AS (SELECT *, tp * 195.0 - fp * 5.0 - fn * 200.0 AS ml_profit,
                 CAST(total AS DOUBLE) * {sql_double(0.113)} * 195.0 - CAST(total AS DOUBLE) * {sql_double(1.0 - 0.113)} * 5.0 AS call_all_profit FROM v)
    SELECT total, n_yes, n_no, avg_prob, ml_profit, call_all_profit, ml_profit - call_all_profit AS advantage,
           CASE WHEN call_all_profit > 0 THEN (ml_profit / call_all_profit - 1) * 100 END AS advantage_pct FROM m""",
)
def q_campaign_impact(spark, sf):
    from leadlens.operators.leads import batch_summary, campaign_impact

    return campaign_impact(batch_summary(_scored(spark, sf), CALL_T))


@register(
    "top_leads",
    f"WITH {LEADS} SELECT lead_id, score AS probability, month FROM leads ORDER BY score DESC, lead_id ASC LIMIT 20",
)
def q_top_leads(spark, sf):
    from leadlens.operators.leads import top_leads

    return top_leads(_scored(spark, sf).select("lead_id", "probability", "month"), "probability", "lead_id", 20)


def _zone_sql(p: str, t: float) -> str:
    return (
        f"CASE WHEN {p} >= 0.0 AND {p} < {sql_double(0.05)} THEN 'DO NOT CALL' "
        f"WHEN {p} >= {sql_double(0.05)} AND {p} < {sql_double(t)} THEN 'LOW PRIORITY' "
        f"WHEN {p} >= {sql_double(t)} AND {p} < {sql_double(1.01)} THEN 'CALL NOW' END"
    )


@register(
    "decision_zones",
    f"""WITH {LEADS}, z AS (SELECT * FROM (VALUES (0, 'DO NOT CALL'), (1, 'LOW PRIORITY'), (2, 'CALL NOW')) v(zone_order, zone)),
    g AS (SELECT {_zone_sql('score', CALL_T)} AS zone, count(*) AS n, sum(y) AS subs, avg(score) AS ap FROM leads GROUP BY 1),
    j AS (SELECT CAST(zone_order AS INTEGER) AS zone_order, zone, coalesce(n, 0) AS n, CAST(coalesce(subs, 0) AS BIGINT) AS subscribers,
                 CASE WHEN n > 0 THEN round(subs / n * 100, 2) ELSE 0.0 END AS conversion_pct,
                 CASE WHEN n > 0 THEN round(ap, 4) ELSE 0.0 END AS avg_prob,
                 CAST(coalesce(subs, 0) * 200 AS BIGINT) AS revenue_at_risk, CAST(coalesce(n, 0) * 5 AS BIGINT) AS call_cost
          FROM z LEFT JOIN g USING (zone))
    SELECT *, CAST(sum(n) OVER (ORDER BY zone_order ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS calls_saved_if_skipped FROM j""",
)
def q_decision_zones(spark, sf):
    from leadlens.operators.leads import decision_zones

    return decision_zones(_scored(spark, sf), CALL_T)


PROFILE_FEATS = ["status", "month", "day_of_week"]


def _profile_sql(seg_expr: str, name: str, where: str = "TRUE") -> str:
    parts = " UNION ALL ".join(
        f"SELECT {seg_expr} AS {name}, '{f}' AS feature, CAST({f} AS VARCHAR) AS level, y FROM leads WHERE {where}" for f in PROFILE_FEATS
    )
    return f"""lng AS ({parts}),
    cnt AS (SELECT {name}, feature, level, count(*) AS n, sum(y) AS subs FROM lng GROUP BY ALL),
    rk AS (SELECT *, sum(n) OVER (PARTITION BY {name}, feature) AS seg_n,
                  row_number() OVER (PARTITION BY {name}, feature ORDER BY n DESC, level ASC) AS rank FROM cnt)
    SELECT {name}, feature, CAST(rank AS INTEGER) AS rank, level, n, n / seg_n * 100 AS pct_of_segment,
           CAST(subs AS BIGINT) AS subscribers, subs / seg_n * 100 AS subscriber_pct_of_segment FROM rk WHERE rank <= 6"""


@register("zone_profile", f"WITH {LEADS}, {_profile_sql(_zone_sql('score', CALL_T), 'zone', _zone_sql('score', CALL_T) + ' IS NOT NULL')}")
def q_zone_profile(spark, sf):
    from leadlens.operators.leads import zone_profile

    return zone_profile(_scored(spark, sf), CALL_T, PROFILE_FEATS)


def _tier_sql(p: str) -> str:
    return f"CASE WHEN {p} >= {sql_double(0.35)} THEN 'Hot' WHEN {p} >= {sql_double(0.11)} THEN 'Warm' ELSE 'Cold' END"


@register("fixed_tiers", f"WITH {LEADS} SELECT lead_id, score AS probability, {_tier_sql('score')} AS tier FROM leads")
def q_fixed_tiers(spark, sf):
    from leadlens.operators.leads import fixed_tiers

    return fixed_tiers(_scored(spark, sf).select("lead_id", "probability"))


_TIER_RULES_SQL = f"""tr AS (SELECT {_tier_sql('score')} AS tier, count(*) AS n, CAST(sum(y) AS BIGINT) AS subscribers,
        avg(score) AS ap, min(score) AS min_prob, max(score) AS max_prob,
        count(*) FILTER (WHERE score >= {sql_double(CALL_T)} AND y = 1) AS tp,
        count(*) FILTER (WHERE score >= {sql_double(CALL_T)} AND y = 0) AS fp,
        count(*) FILTER (WHERE NOT (score >= {sql_double(CALL_T)}) AND y = 1) AS fn FROM leads GROUP BY 1),
    rules AS (SELECT tier, n, subscribers, round(subscribers / n * 100, 2) AS conversion_pct, round(ap, 4) AS avg_prob,
        min_prob, max_prob, {_profit_sql()} AS net_profit,
        CASE tier WHEN 'Hot' THEN 'Priority call — senior agent' WHEN 'Warm' THEN 'Standard call queue' ELSE 'Email nurture / skip' END AS action,
        n / sum(n) OVER () * 100 AS share_pct FROM tr)"""


@register("tier_rules", f"WITH {LEADS}, {_TIER_RULES_SQL} SELECT * FROM rules")
def q_tier_rules(spark, sf):
    from leadlens.operators.leads import fixed_tiers, tier_rules

    return tier_rules(fixed_tiers(_scored(spark, sf)), CALL_T)


@register("tier_profile", f"WITH {LEADS}, {_profile_sql(_tier_sql('score'), 'tier')}")
def q_tier_profile(spark, sf):
    from leadlens.operators.leads import fixed_tiers, tier_profile

    return tier_profile(fixed_tiers(_scored(spark, sf)), PROFILE_FEATS)


@register(
    "tier_economics",
    f"""WITH {LEADS}, {_TIER_RULES_SQL}
    SELECT tier, n, subscribers, subscribers / n * 100 AS conversion_pct, subscribers * CAST(200 AS DOUBLE) AS revenue_at_risk,
           n * CAST(5 AS DOUBLE) AS call_cost, subscribers * CAST(195 AS DOUBLE) AS tp_revenue FROM rules""",
)
def q_tier_economics(spark, sf):
    from leadlens.operators.leads import fixed_tiers, tier_economics, tier_rules

    return tier_economics(tier_rules(fixed_tiers(_scored(spark, sf)), CALL_T))


# every pair of cuts over the distinct rounded scores
_KMEANS_SQL = """h AS (SELECT CAST(round(score * 10000) AS BIGINT) AS v, count(*) AS n FROM leads GROUP BY 1),
    c AS (SELECT v, CAST(sum(n) OVER o AS DOUBLE) AS cn, CAST(sum(n * v) OVER o AS DOUBLE) AS cs, CAST(sum(n * v * v) OVER o AS DOUBLE) AS cq
        FROM h WINDOW o AS (ORDER BY v)),
    e AS (SELECT max(cn) AS zn, max(cs) AS zs, max(cq) AS zq FROM c),
    p AS (SELECT a.v AS a, b.v AS b, a.cq - a.cs * a.cs / a.cn + (b.cq - a.cq) - (b.cs - a.cs) * (b.cs - a.cs) / (b.cn - a.cn)
        + (zq - b.cq) - (zs - b.cs) * (zs - b.cs) / (zn - b.cn) AS spread FROM c a JOIN c b ON b.v > a.v CROSS JOIN e WHERE b.cn < zn),
    cut AS (SELECT a, b FROM p ORDER BY spread, a, b LIMIT 1),
    tiers AS (SELECT lead_id, score AS probability, round(score * 10000) AS v,
        CASE WHEN round(score * 10000) <= a THEN 'Cold' WHEN round(score * 10000) <= b THEN 'Warm' ELSE 'Hot' END AS tier FROM leads CROSS JOIN cut)"""


@register("kmeans_tiers", f"WITH {LEADS}, {_KMEANS_SQL} SELECT lead_id, probability, tier FROM tiers")
def q_kmeans_tiers(spark, sf):
    from leadlens.operators.leads import kmeans_tiers

    return kmeans_tiers(_scored(spark, sf).select("lead_id", "probability"))


@register(
    "kmeans_centres",
    f"""WITH {LEADS}, {_KMEANS_SQL} SELECT tier, min(v) / 10000 AS lo, max(v) / 10000 AS hi, count(*) AS n, sum(v) / count(*) / 10000 AS centre
    FROM tiers GROUP BY tier""",
)
def q_kmeans_centres(spark, sf):
    from leadlens.operators.leads import kmeans_cuts

    groups = kmeans_cuts(_scored(spark, sf))
    rows = [(name, float(g["lo"]), float(g["hi"]), g["n"], float(g["centre"])) for name, g in zip(("Cold", "Warm", "Hot"), groups)]
    return spark.createDataFrame(rows, "tier string, lo double, hi double, n long, centre double")


@register(
    "sanitise_numeric",
    f"""WITH {PROSPECTS} SELECT prospect_id,
    greatest(least(CASE WHEN amount IS NULL OR isnan(amount) OR amount IN ('inf'::DOUBLE, '-inf'::DOUBLE) THEN 0.0 ELSE amount END, 1e9), -1e9) AS amount,
    greatest(least(CAST(pdays AS DOUBLE), 1e9), -1e9) AS pdays FROM prospects""",
)
def q_sanitise_numeric(spark, sf):
    from leadlens.operators.leads import sanitise_numeric

    return sanitise_numeric(ds.prospects(spark, sf).select("prospect_id", "amount", "pdays"), ["amount", "pdays"])


# ===========================================================================
# 2.5 Split and folds, 2.6 encoding (bank-shaped customers over orders)
# ===========================================================================
BANK = f"bank AS ({ds.BANK_SQL})"


def _split_sql(src: str = "bank", key: str = "client_id") -> str:
    c1, c2 = 0.0 + 0.70, 0.0 + 0.70 + 0.15
    return f"""sp AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(CAST({key} AS VARCHAR) || '-42'), {key}) AS rk,
                        count(*) OVER (PARTITION BY y) AS cn FROM {src}),
    s AS (SELECT * EXCLUDE (rk, cn), CASE WHEN rk <= round(cn * {sql_double(c1)}) THEN 'train'
                                          WHEN rk <= round(cn * {sql_double(c2)}) THEN 'val' ELSE 'test' END AS split FROM sp)"""


def _bank(spark, sf):
    return ds.bank_customers(spark, sf)


def _bank_split(spark, sf):
    from leadlens.operators.split import stratified_split

    return stratified_split(_bank(spark, sf), "client_id", "y")


@register("stratified_split", f"WITH {BANK}, {_split_sql()} SELECT client_id, y, split FROM s")
def q_stratified_split(spark, sf):
    return _bank_split(spark, sf).select("client_id", "y", "split")


@register(
    "stratified_kfold",
    f"""WITH {BANK}, f AS (SELECT client_id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY md5(CAST(client_id AS VARCHAR) || '-42'), client_id) - 1) % 5 AS INTEGER) AS fold FROM bank)
    SELECT * FROM f""",
)
def q_stratified_kfold(spark, sf):
    from leadlens.operators.split import stratified_kfold

    return stratified_kfold(_bank(spark, sf), "client_id", "y", 5).select("client_id", "y", "fold")


@register("union_splits", f"WITH {BANK}, {_split_sql()} SELECT client_id, y, split FROM s WHERE split IN ('train', 'val')")
def q_union_splits(spark, sf):
    from leadlens.operators.split import take_split, union_splits

    s = _bank_split(spark, sf).select("client_id", "y", "split")
    return union_splits(take_split(s, "train"), take_split(s, "val"))


@register(
    "split_summary",
    f"WITH {BANK}, {_split_sql()} SELECT split, count(*) AS n, avg(CAST(y AS DOUBLE)) AS positive_rate FROM s GROUP BY split",
)
def q_split_summary(spark, sf):
    from leadlens.operators.split import split_summary

    return split_summary(_bank_split(spark, sf))


BANK_NUMS = ["age", "campaign", "previous", "emp.var.rate", "cons.price.idx", "cons.conf.idx", "euribor3m", "nr.employed"]
OH_COLS = ["contact", "marital", "housing", "month"]
OH_LEVELS = {
    "contact": ["cellular", "telephone"],
    "marital": ["divorced", "married", "single", "unknown"],
    "housing": ["no", "unknown", "yes"],
    "month": ["apr", "aug", "dec", "feb", "jan", "jul", "jun", "mar", "may", "nov", "oct", "sep"],
}


def _safe(n: str) -> str:
    return n.replace(".", "_").replace(" ", "_")


def _scale_sql() -> str:
    stats = ", ".join(f'avg(CAST("{c}" AS DOUBLE)) AS "m_{c}", stddev_pop(CAST("{c}" AS DOUBLE)) AS "s_{c}"' for c in BANK_NUMS)
    cols = ", ".join(
        f'(CAST("{c}" AS DOUBLE) - "m_{c}") / CASE WHEN "s_{c}" IS NULL OR "s_{c}" = 0 THEN 1.0 ELSE "s_{c}" END AS num__{_safe(c)}'
        for c in BANK_NUMS
    )
    return f"st AS (SELECT {stats} FROM s WHERE split = 'train'), sc AS (SELECT s.client_id, {cols} FROM s, st)"


def _onehot_sql() -> str:
    cols = []
    for c, lv in OH_LEVELS.items():
        kept = lv[1:] if len(lv) == 2 else lv
        cols += [f"CAST(coalesce(CAST({c} = '{v}' AS INTEGER), 0) AS INTEGER) AS nom__{c}_{_safe(v)}" for v in kept]
    return ", ".join(cols)


def _ord_sql(col: str = "education") -> str:
    from leadlens.operators.features import EDUCATION_ORDER

    arr = "[" + ", ".join(f"'{v}'" for v in EDUCATION_ORDER) + "]"
    return f"CAST(coalesce(list_position({arr}, {col}) - 1, -1) AS INTEGER)"


@register("standard_scale", f"WITH {BANK}, {_split_sql()}, {_scale_sql()} SELECT * FROM sc")
def q_standard_scale(spark, sf):
    from leadlens.operators.features import standard_scale
    from leadlens.operators.split import take_split

    s = _bank_split(spark, sf)
    out = standard_scale(s, BANK_NUMS, fit_on=take_split(s, "train"))
    return out.select("client_id", *[f"num__{_safe(c)}" for c in BANK_NUMS])


@register("ordinal_encode", f"WITH {BANK} SELECT client_id, education, {_ord_sql()} AS ord__education FROM bank")
def q_ordinal_encode(spark, sf):
    from leadlens.operators.features import ordinal_encode

    return ordinal_encode(_bank(spark, sf).select("client_id", "education"), "education")


@register("one_hot", f"WITH {BANK}, {_split_sql()} SELECT client_id, {_onehot_sql()} FROM s")
def q_one_hot(spark, sf):
    from leadlens.operators.features import one_hot, one_hot_columns  # noqa: F401
    from leadlens.operators.split import take_split

    s = _bank_split(spark, sf)
    out = one_hot(s, OH_COLS, fit_on=take_split(s, "train"))
    return out.select("client_id", *[c for c in out.columns if c.startswith("nom__")])


def _assembled_sql() -> str:
    oh = ", ".join(f"CAST({x.split(' AS ')[0]} AS DOUBLE) AS {x.split(' AS ')[-1]}" for x in _onehot_sql().split(", CAST(") if x)
    return oh


@register(
    "assemble_features",
    f"""WITH {BANK}, {_split_sql()}, {_scale_sql()},
    oh AS (SELECT client_id, CAST({_ord_sql()} AS DOUBLE) AS ord__education, {_onehot_sql()} FROM s)
    SELECT sc.*, oh.* EXCLUDE (client_id) FROM sc JOIN oh USING (client_id)""",
)
def q_assemble_features(spark, sf):
    from leadlens.operators.features import fit_preprocessor
    from leadlens.operators.split import take_split

    s = _bank_split(spark, sf)
    pre = fit_preprocessor(take_split(s, "train"), BANK_NUMS, "education", OH_COLS)
    out = pre.transform(s, keep=["client_id"])
    # one-hot indicators as int like the standalone encoder; the vector form is assemble_features()
    return out.withColumns({c: F.col(c).cast("int") for c in out.columns if c.startswith("nom__")})


@register(
    "class_weights",
    f"""WITH {BANK}, {_split_sql()}, c AS (SELECT y, count(*) AS n FROM s WHERE split = 'train' GROUP BY y)
    SELECT y, n, sum(n) OVER () / (2.0 * n) AS weight,
           round(CAST(sum(n) FILTER (WHERE y = 0) OVER () AS DOUBLE) / sum(n) FILTER (WHERE y = 1) OVER (), 2) AS scale_pos_weight FROM c""",
)
def q_class_weights(spark, sf):
    from leadlens.operators.split import take_split
    from leadlens.operators.train import class_weights

    return class_weights(take_split(_bank_split(spark, sf), "train"), "y")


# ===========================================================================
# 2.2 Projection, filter, scalar expressions
# ===========================================================================
@register(
    "sentinel_split",
    f"""WITH {BANK} SELECT client_id, CAST(pdays <> 999 AS INTEGER) AS was_previously_contacted,
    CASE WHEN pdays <> 999 THEN ln(1 + CAST(pdays AS DOUBLE)) WHEN pdays = 999 THEN 0.0 END AS pdays_log FROM bank""",
)
def q_sentinel_split(spark, sf):
    from leadlens.functions.columns import sentinel_split

    return sentinel_split(_bank(spark, sf).select("client_id", "pdays"), "pdays")


def _labels_sql(col: str, edges, labels) -> str:
    w = " ".join(
        f"WHEN {col} > {sql_double(float(edges[i]))} AND {col} <= {sql_double(float(edges[i + 1]))} THEN '{labels[i]}'"
        for i in range(len(labels))
    )
    return f"CASE {w} END"


@register(
    "fixed_bins",
    f"""WITH {BANK} SELECT client_id,
    {_labels_sql('age', [0, 30, 45, 60, float('inf')], ['young', 'prime', 'middle', 'senior'])} AS age_bin,
    {_labels_sql('campaign', [0, 2, 5, float('inf')], ['low', 'moderate', 'high'])} AS campaign_bin,
    {_labels_sql('euribor3m', [float('-inf'), 1.5, 3.5, float('inf')], ['low_rate', 'mid_rate', 'high_rate'])} AS euribor3m_bin FROM bank""",
)
def q_fixed_bins(spark, sf):
    from leadlens.functions.columns import fixed_bins

    return fixed_bins(_bank(spark, sf).select("client_id", "age", "campaign", "euribor3m")).select(
        "client_id", "age_bin", "campaign_bin", "euribor3m_bin"
    )


AGE_EDGES = [17, 25, 35, 45, 55, 65, 100]
AGE_LABELS = ["(%d, %d]" % (AGE_EDGES[i], AGE_EDGES[i + 1]) for i in range(len(AGE_EDGES) - 1)]


@register(
    "cut_bins",
    f"""WITH {BANK} SELECT {_labels_sql('age', AGE_EDGES, AGE_LABELS)} AS age_band,
    avg(CAST(y AS DOUBLE)) * 100 AS conversion_pct, count(*) AS n FROM bank GROUP BY 1""",
)
def q_cut_bins(spark, sf):
    from leadlens.functions.columns import bin_label

    return pr.conversion_by_bin(_bank(spark, sf), bin_label("age", AGE_EDGES), "y", "age_band")


@register("cap_value", f"WITH {BANK} SELECT client_id, least(campaign, 10) AS campaign FROM bank")
def q_cap_value(spark, sf):
    from leadlens.functions.columns import cap_value

    return _bank(spark, sf).select("client_id", cap_value("campaign", 10).alias("campaign"))


@register(
    "threshold_predict",
    f"WITH {LEADS} SELECT lead_id, CAST(score >= {sql_double(0.3)} AS INTEGER) AS y_pred FROM leads",
)
def q_threshold_predict(spark, sf):
    from leadlens.functions.columns import threshold_predict

    return ds.leads(spark, sf).select("lead_id", threshold_predict("score", 0.3).alias("y_pred"))


@register(
    "expected_value",
    f"WITH {LEADS} SELECT lead_id, score * 200.0 - (1.0 - score) * 5.0 AS expected_value FROM leads",
)
def q_expected_value(spark, sf):
    from leadlens.functions.columns import expected_value

    return ds.leads(spark, sf).select("lead_id", expected_value("score").alias("expected_value"))


@register(
    "verdict",
    f"""WITH {LEADS} SELECT lead_id, score >= {sql_double(CALL_T)} AS will_subscribe,
    CASE WHEN score >= {sql_double(CALL_T)} THEN 'LIKELY TO SUBSCRIBE' ELSE 'UNLIKELY TO SUBSCRIBE' END AS verdict,
    CASE WHEN score >= {sql_double(CALL_T)} THEN 'Recommended Action: Call this customer'
         ELSE 'Recommended Action: Skip — focus resources elsewhere' END AS action,
    CASE WHEN score >= {sql_double(0.6)} THEN 'Very High Confidence' WHEN score >= {sql_double(0.35)} THEN 'High Confidence'
         WHEN score >= {sql_double(CALL_T)} THEN 'Moderate Confidence' WHEN score >= {sql_double(CALL_T * 0.5)} THEN 'Low Confidence'
         ELSE 'Very Low' END AS confidence,
    score * 200.0 - (1.0 - score) * 5.0 AS expected_value FROM leads""",
)
def q_verdict(spark, sf):
    from leadlens.functions.columns import verdict

    return verdict(ds.leads(spark, sf).select("lead_id", "score"), "score", CALL_T).drop("score")


def _title(c: str) -> str:
    return f"upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"


@register(
    "reason_codes",
    f"""WITH {BANK} SELECT client_id,
    concat_ws('|',
      CASE WHEN poutcome = 'success' THEN 'Previous campaign: Success' END,
      CASE WHEN coalesce(contact = 'cellular', false) THEN 'Mobile contact' END,
      CASE WHEN coalesce(euribor3m, 5.0) < 2 THEN 'Low interest rates' END,
      CASE WHEN job IN ('retired', 'student') THEN {_title('job')} || ' - high-value' END,
      CASE WHEN month IN ('mar', 'sep', 'oct', 'dec') THEN 'Strong month (' || {_title('month')} || ')' END,
      CASE WHEN NOT (coalesce(campaign, 0) > 5) AND coalesce(campaign, 99) <= 2 THEN 'Fresh lead (2 or fewer calls)' END,
      CASE WHEN coalesce(age, 0) > 60 THEN 'Senior (60+)' WHEN coalesce(age, 0) < 30 THEN 'Young (<30)' END,
      CASE WHEN coalesce(pdays, 999) > 0 AND coalesce(pdays, 999) < 30 THEN 'Recently contacted' END,
      CASE WHEN housing = 'no' AND loan = 'no' THEN 'No existing loans' END,
      CASE WHEN coalesce("nr.employed", 5200.0) < 5100 THEN 'Receptive market' END) AS positive,
    concat_ws('|',
      CASE WHEN poutcome = 'failure' THEN 'Previous campaign: Failed' END,
      CASE WHEN NOT coalesce(contact = 'cellular', false) THEN 'Landline contact' END,
      CASE WHEN NOT (coalesce(euribor3m, 5.0) < 2) AND coalesce(euribor3m, 0.0) > 4 THEN 'High interest rates' END,
      CASE WHEN coalesce(campaign, 0) > 5 THEN CAST(campaign AS VARCHAR) || ' calls - diminishing returns' END) AS negative
    FROM bank""",
)
def q_reason_codes(spark, sf):
    from leadlens.functions.columns import reason_codes

    pos, neg = reason_codes()
    return _bank(spark, sf).select("client_id", F.array_join(pos, "|").alias("positive"), F.array_join(neg, "|").alias("negative"))


def _messy(spark, sf) -> DataFrame:
    """Upload-style frame: odd-cased names, aliases, leakage and extra columns, some columns missing."""
    b = _bank(spark, sf)
    return b.select(
        F.col("client_id").alias(" Client_ID "),
        F.col("age").alias("AGE"),
        "job", "marital", "education", "default", "housing", "loan", "contact", "month",
        F.col("day_of_week").alias("Day"),
        "duration", "campaign",
        F.col("`emp.var.rate`").alias("EMP_VAR_RATE"),
        F.col("`cons.price.idx`").alias("ConsPriceIdx"),
        F.col("y").alias("Y"),
    )


_MESSY_SQL = """messy AS (SELECT client_id AS " Client_ID ", age AS "AGE", job, marital, education, "default", housing, loan, contact, month,
    day_of_week AS "Day", duration, campaign, "emp.var.rate" AS "EMP_VAR_RATE", "cons.price.idx" AS "ConsPriceIdx", y AS "Y" FROM bank)"""


@register(
    "normalise_columns",
    f"""WITH {BANK}, {_MESSY_SQL} SELECT " Client_ID " AS client_id, "AGE" AS age, job, marital, education, "default", housing, loan,
    contact, month, "Day" AS day_of_week, duration, campaign, "EMP_VAR_RATE" AS "emp.var.rate", "ConsPriceIdx" AS "cons.price.idx", "Y" AS y FROM messy""",
)
def q_normalise_columns(spark, sf):
    from leadlens.operators.schema import normalise_columns

    return normalise_columns(_messy(spark, sf))


@register(
    "conform_schema",
    f"""WITH {BANK}, {_MESSY_SQL}
    SELECT CAST("AGE" AS DOUBLE) AS age, job, marital, education, "default", housing, loan, contact, month, "Day" AS day_of_week,
           CAST(campaign AS DOUBLE) AS campaign, CAST(999 AS DOUBLE) AS pdays, CAST(0 AS DOUBLE) AS previous, 'nonexistent' AS poutcome,
           CAST("EMP_VAR_RATE" AS DOUBLE) AS "emp.var.rate", CAST("ConsPriceIdx" AS DOUBLE) AS "cons.price.idx",
           CAST('-36.4' AS DOUBLE) AS "cons.conf.idx", CAST('4.857' AS DOUBLE) AS euribor3m, CAST('5191.0' AS DOUBLE) AS "nr.employed"
    FROM messy""",
)
def q_conform_schema(spark, sf):
    from leadlens.operators.schema import conform_schema

    out, _warns, _missing = conform_schema(_messy(spark, sf))
    return out


# ===========================================================================
# 2.1 Sources and sinks (round trips through the shared checkpoint folder)
# ===========================================================================
RAW_COLS = [f.name for f in __import__("leadlens.sources.io", fromlist=["BANK_SCHEMA"]).BANK_SCHEMA.fields]


def _raw_bank(spark, sf) -> DataFrame:
    """The bank view as a raw file would hold it: 20 inputs + yes/no target."""
    b = _bank(spark, sf)
    return b.select(*[F.col(f"`{c}`") for c in RAW_COLS if c != "y"], F.when(F.col("y") == 1, "yes").otherwise("no").alias("y"))


_RAW_SQL_COLS = ", ".join(f'"{c}"' for c in RAW_COLS if c != "y")


@register("read_delimited", f"WITH {BANK} SELECT {_RAW_SQL_COLS}, y FROM bank")
def q_read_delimited(spark, sf):
    from leadlens.session import scratch_path
    from leadlens.sources.io import read_delimited, write_delimited

    path = write_delimited(_raw_bank(spark, sf), scratch_path(spark, "raw-bank"))
    n = ds.table(spark, sf, "orders").count()
    return read_delimited(spark, path, expect_rows=n)


@register(
    "validate_shape",
    f"WITH {BANK} SELECT count(*) AS n_rows, CAST(21 AS INTEGER) AS n_cols, count(*) = count(*) AS shape_ok FROM (SELECT {_RAW_SQL_COLS}, y FROM bank)",
)
def q_validate_shape(spark, sf):
    from leadlens.operators.schema import validate_shape

    raw = _raw_bank(spark, sf)
    return validate_shape(raw, ds.table(spark, sf, "orders").count(), 21)


@register("encode_target", f"WITH {BANK} SELECT client_id, y FROM bank")
def q_encode_target(spark, sf):
    from leadlens.operators.schema import encode_target

    b = _bank(spark, sf).select("client_id", F.when(F.col("y") == 1, "yes").otherwise("no").alias("y"))
    return encode_target(b, "y")


@register("write_splits", f"WITH {BANK}, {_split_sql()} SELECT client_id, y, split FROM s")
def q_write_splits(spark, sf):
    from leadlens.session import scratch_path
    from leadlens.sources.io import read_splits, write_splits

    base = scratch_path(spark, "splits")
    write_splits(_bank_split(spark, sf).select("client_id", "y", "split"), base)
    return read_splits(spark, base).select("client_id", "y", "split")


@register(
    "write_report",
    f"""WITH {LEADS}, {_sweep_sql(_values_sql(ev.arange(0.05, 0.95, 0.05)))}
    SELECT round(threshold, 2) AS threshold, tp + fp AS calls_made, round({_profit_sql()}, 0) AS net_profit FROM sw""",
)
def q_write_report(spark, sf):
    from leadlens.session import scratch_path
    from leadlens.sources.io import write_report

    rep = ev.recall_analysis(ds.leads(spark, sf), "y", "score").select("threshold", "calls_made", "net_profit")
    path = write_report(rep, scratch_path(spark, "recall-report"), "json")
    return spark.read.schema("threshold double, calls_made long, net_profit double").json(path)


@register(
    "write_predictions",
    f"WITH {LEADS} SELECT lead_id, round(score, 4) AS probability, CASE WHEN score >= {sql_double(CALL_T)} THEN 'YES' ELSE 'NO' END AS verdict FROM leads",
)
def q_write_predictions(spark, sf):
    from leadlens.operators.leads import batch_score
    from leadlens.session import scratch_path
    from leadlens.sources.io import write_predictions

    scored = batch_score(_scored(spark, sf).select("lead_id", "probability"), CALL_T)
    path = write_predictions(scored, scratch_path(spark, "predictions"))
    return spark.read.schema("lead_id long, probability double, verdict string").option("header", True).csv(path)


@register("preview", f"WITH {BANK} SELECT client_id, age, job, y FROM bank ORDER BY client_id LIMIT 5")
def q_preview(spark, sf):
    from leadlens.sources.io import preview

    return preview(_bank(spark, sf).select("client_id", "age", "job", "y"), ["client_id"], 5)


# ===========================================================================
# 2.7 Training, tuning, importance (MLlib on the bank-shaped customers)
# ===========================================================================
def _train_test(spark, sf):
    from leadlens.operators.split import take_split
    from leadlens.session import materialize

    # the split feeds many passes (indexers, scaler, iterations): cut its lineage once
    s = materialize(_bank_split(spark, sf).drop("duration"))
    return take_split(s, "train").drop("split"), take_split(s, "test").drop("split")


def _train_folds(spark, sf):
    from leadlens.operators.split import stratified_kfold

    from leadlens.session import materialize

    train, _ = _train_test(spark, sf)
    return materialize(stratified_kfold(train, "client_id", "y", 5))


MI_FEATS = ["job", "marital", "education", "contact", "month", "poutcome"]


@register(
    "mutual_information",
    f"""WITH {BANK}, lng AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS level, y FROM bank" for f in MI_FEATS)}),
    c AS (SELECT feature, level, y, count(*) AS n_xy FROM lng GROUP BY ALL),
    t AS (SELECT *, sum(n_xy) OVER (PARTITION BY feature) AS n, sum(n_xy) OVER (PARTITION BY feature, level) AS n_x,
                 sum(n_xy) OVER (PARTITION BY feature, y) AS n_y FROM c)
    SELECT feature, sum(n_xy / n * ln(n_xy * n / (n_x * n_y))) AS mutual_info FROM t GROUP BY feature""",
)
def q_mutual_information(spark, sf):
    from leadlens.operators.train import mutual_information

    return mutual_information(_bank(spark, sf), MI_FEATS, "y")


ANOVA_FEATS = ["age", "campaign", "pdays", "previous", "emp.var.rate", "euribor3m", "nr.employed"]


@register(
    "anova_f",
    f"""WITH {BANK}, lng AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, CAST(\"{f}\" AS DOUBLE) AS x, y FROM bank" for f in ANOVA_FEATS)}),
    g AS (SELECT feature, y, count(*) AS n, sum(x) AS s, sum(x * x) AS ss FROM lng WHERE x IS NOT NULL AND NOT isnan(x) GROUP BY ALL),
    t AS (SELECT feature, sum(n) AS N, sum(s) AS S, sum(ss) AS SS, count(*) AS k, sum(s * s / n) AS b FROM g GROUP BY feature)
    SELECT feature, CASE WHEN k > 1 AND N > k AND SS - b > 0 THEN ((b - S * S / N) / (k - 1)) / ((SS - b) / (N - k)) END AS f_stat FROM t""",
)
def q_anova_f(spark, sf):
    from leadlens.operators.train import anova_f

    return anova_f(_bank(spark, sf), ANOVA_FEATS, "y")


ATTR_COEFS = {"age": 0.012, "campaign": -0.08, "euribor3m": -0.35, "nr.employed": -0.004, "cons.conf.idx": 0.02}


@register(
    "linear_attribution",
    f"""WITH {BANK}, m AS (SELECT {', '.join(f'avg(CAST("{c}" AS DOUBLE)) AS "m_{c}"' for c in ATTR_COEFS)} FROM bank),
    a AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, avg(abs({sql_double(v)} * (CAST(\"{c}\" AS DOUBLE) - \"m_{c}\"))) AS mean_abs_attribution FROM bank, m" for c, v in ATTR_COEFS.items())})
    SELECT * FROM a""",
)
def q_linear_attribution(spark, sf):
    from leadlens.operators.train import linear_attribution

    return linear_attribution(_bank(spark, sf), ATTR_COEFS)


@register(
    "local_cases",
    f"""WITH {LEADS} SELECT 'max_prob' AS "case", arg_min(lead_id, (-score, lead_id)) AS lead_id FROM leads
    UNION ALL SELECT 'min_prob', arg_min(lead_id, (score, lead_id)) FROM leads
    UNION ALL SELECT 'near_threshold', arg_min(lead_id, (abs(score - {sql_double(0.3)}), lead_id)) FROM leads
    UNION ALL SELECT 'first_tp', min(lead_id) FILTER (WHERE score >= 0.5 AND y = 1) FROM leads
    UNION ALL SELECT 'first_tn', min(lead_id) FILTER (WHERE score <= {sql_double(0.1)} AND y = 0) FROM leads""",
)
def q_local_cases(spark, sf):
    from leadlens.operators.train import local_cases

    return local_cases(ds.leads(spark, sf), "lead_id", "score", "y", 0.30)


# ===========================================================================
# Streaming: the batch-scoring flow as a micro-batch stream over lineitem
# ===========================================================================
@register(
    "score_stream",
    f"WITH {LEADS} SELECT lead_id, round(score, 4) AS probability, CASE WHEN score >= {sql_double(CALL_T)} THEN 'YES' ELSE 'NO' END AS verdict FROM leads",
)
def q_score_stream(spark, sf):
    from leadlens.session import scratch_path
    from leadlens.streaming.scoring import run_to_completion, score_stream

    src = f"{sf.rstrip('/')}/lineitem.parquet"
    schema = spark.read.parquet(src).schema
    score_expr = [e for e in ds.LEADS_EXPRS if e.endswith(" AS score")][0].replace(" AS score", " AS probability")

    def scorer(df: DataFrame) -> DataFrame:
        return df.selectExpr("l_orderkey * 10 + l_linenumber AS lead_id", score_expr)

    sink = scratch_path(spark, "scored-stream")
    q = score_stream(spark, sf.rstrip("/"), schema, scorer, CALL_T, sink, sanitise=False, keep=("lead_id",), glob="lineitem.parquet")
    run_to_completion(q)
    return spark.read.parquet(sink)


# ===========================================================================
# 2.8 Before / after tuning over the stand-in models
# ===========================================================================
def _stage_thresholds(spark, sf):
    """baseline and tuned stages at 0.5; 'optimised' = tuned scores at the optimal threshold."""
    scores = ds.model_scores(spark, sf)
    opt = {r["model"]: r["threshold"] for r in ev.find_optimal_threshold(ds.model_scores(spark, sf, ("tuned",)), "y", "score", by="model").collect()}
    th = {}
    for m in ds.SCORERS:
        th[(m, "baseline")] = 0.5
        th[(m, "tuned")] = 0.5
    optimised = scores.where("stage = 'tuned'").withColumn("stage", F.lit("optimised"))
    for m, t in opt.items():
        th[(m, "optimised")] = t
    return scores.unionByName(optimised), th


_STAGES_SQL = f"""{SCORES}, tuned AS (SELECT * FROM scores WHERE stage = 'tuned'), {_opt_sql('tuned')},
    st AS (SELECT model, stage, y, score, 0.5 AS t FROM scores
           UNION ALL SELECT s.model, 'optimised', s.y, s.score, o.threshold FROM tuned s JOIN opt o USING (model)),
    sc AS (SELECT model, stage, {_conf_sql('score >= t')} FROM st GROUP BY model, stage),
    costs AS (SELECT model, stage, CAST(tp * 195 AS DOUBLE) AS tp_revenue, CAST(fp * 5 AS DOUBLE) AS fp_cost,
                     CAST(fn * 200 AS DOUBLE) AS fn_loss, {_profit_sql()} AS net_profit FROM sc)"""


@register(
    "cost_breakdown",
    f"""WITH {_STAGES_SQL}, c2 AS (SELECT * FROM costs WHERE stage IN ('baseline', 'tuned'))
    SELECT * FROM c2 UNION ALL
    SELECT model, 'delta', sum(CASE stage WHEN 'tuned' THEN tp_revenue ELSE -tp_revenue END),
           sum(CASE stage WHEN 'tuned' THEN fp_cost ELSE -fp_cost END), sum(CASE stage WHEN 'tuned' THEN fn_loss ELSE -fn_loss END),
           sum(CASE stage WHEN 'tuned' THEN net_profit ELSE -net_profit END) FROM c2 GROUP BY model""",
)
def q_cost_breakdown(spark, sf):
    scores, th = _stage_thresholds(spark, sf)
    costs = ev.stage_costs(scores.where("stage IN ('baseline', 'tuned')"), th, prob="score")
    return ev.cost_breakdown(costs)


@register(
    "profit_stages",
    f"""WITH {_STAGES_SQL}, w AS (SELECT model, max(net_profit) FILTER (WHERE stage = 'baseline') AS baseline,
        max(net_profit) FILTER (WHERE stage = 'tuned') AS tuned, max(net_profit) FILTER (WHERE stage = 'optimised') AS optimised
        FROM costs GROUP BY model)
    SELECT *, tuned - baseline AS gain_tuning, optimised - tuned AS gain_threshold, optimised - baseline AS total_gain FROM w""",
)
def q_profit_stages(spark, sf):
    scores, th = _stage_thresholds(spark, sf)
    return ev.profit_stages(ev.stage_costs(scores, th, prob="score"))


@register(
    "tuning_comparison",
    f"""WITH {_comparison_sql()}, base AS (SELECT * FROM scores WHERE stage = 'baseline'),
    bm AS (SELECT model, avg(CASE WHEN y = 1 THEN -ln({_pc('score')}) ELSE -ln(1.0 - {_pc('score')}) END) AS log_loss,
                  avg((score - y) * (score - y)) AS brier_score,
                  {_profit_sql("count(*) FILTER (WHERE y = 1 AND score >= 0.5)", "count(*) FILTER (WHERE y = 0 AND score >= 0.5)", "count(*) FILTER (WHERE y = 1 AND score < 0.5)")} AS net_profit
           FROM base GROUP BY model),
    {_rank_sql('base', 'model').replace(' d AS', ' d2 AS').replace('FROM d)', 'FROM d2)').replace(' c AS', ' c2 AS').replace('FROM c ', 'FROM c2 ').replace(' r AS', ' r2 AS')}
    SELECT bm.model, r2.roc_auc AS roc_auc_before, bm.log_loss AS log_loss_before, bm.brier_score AS brier_score_before,
           bm.net_profit AS net_profit_before, cmp.roc_auc AS roc_auc_after, cmp.log_loss AS log_loss_after,
           cmp.brier_score AS brier_score_after, cmp.net_profit AS net_profit_after,
           cmp.roc_auc - r2.roc_auc AS auc_gain, bm.log_loss - cmp.log_loss AS log_loss_gain,
           bm.brier_score - cmp.brier_score AS brier_gain, cmp.net_profit - bm.net_profit AS profit_gain
    FROM bm JOIN r2 USING (model) JOIN cmp USING (model)""",
)
def q_tuning_comparison(spark, sf):
    base = ds.model_scores(spark, sf, ("baseline",))
    before = ev.compute_metrics(base, "y", "score", 0.5, by="model", counts=True).withColumn(
        "net_profit", ev.profit_expr(F.col("tp"), F.col("fp"), F.col("fn")).cast("double")
    )
    return ev.tuning_comparison(before, model_comparison(spark, sf))


@register(
    "pr_curve",
    f"""WITH {LEADS}, {_rank_sql('leads')}
    SELECT score AS threshold, CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg) AS precision,
           CASE WHEN P > 0 THEN CAST(cum_pos AS DOUBLE) / P ELSE 0.0 END AS recall FROM c""",
)
def q_pr_curve(spark, sf):
    return ev.pr_curve(ds.leads(spark, sf), "y", "score")


from leadlens.plans import model_queries, more_queries  # noqa: E402,F401  (they register queries of their own)
