"""Further queries: whole encodings, statistics with p-values, the other grids and strategies, fits on the training rows, cleaning reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlens.operators import evaluate as ev
from leadlens.operators import profile as pr
from leadlens.operators.features import NOMINAL_FEATURES, POST_SENTINEL_NUMERIC
from leadlens.operators.split import stratified_split, take_split
from leadlens.plans import catalog as cat
from leadlens.plans import datasets as ds
from leadlens.plans import model_queries as mq
from leadlens.plans.registry import register, sql_double


# ---------------------------------------------------------------------------
# Whole feature set: 10 numerics, the ordinal one, 9 nominals, by the level dictionary
# ---------------------------------------------------------------------------
def _all_rows(sql: str) -> str:
    return sql.replace(" WHERE split = 'test'", "")


_ENCODED_SQL = f"""{cat.BANK}, {cat._split_sql()}, {mq._KEPT_SQL}, st AS (SELECT {mq._NUM_STATS} FROM s WHERE split = 'train'), v AS ({_all_rows(mq._NUM_ROWS)}
    UNION ALL SELECT client_id, 'ord_education', CAST(coalesce(list_position({mq._EDUCATION}, education) - 1, -1) AS DOUBLE) FROM s
    UNION ALL SELECT client_id, col || '_' || level, 1.0 FROM ({_all_rows(mq._NOM_ROWS)}) JOIN kept USING (col, level))"""


def _encoder(spark, sf):
    from leadlens.functions.columns import sentinel_split
    from leadlens.operators.encoding import fit_sparse_encoder

    s = sentinel_split(cat._bank_split(spark, sf), "pdays")
    return fit_sparse_encoder(take_split(s, "train"), POST_SENTINEL_NUMERIC, "education", NOMINAL_FEATURES), s


@register("assemble_sparse", f"WITH {_ENCODED_SQL} SELECT client_id, feature, round(value, 6) AS value FROM v WHERE round(value, 6) <> 0")
def q_assemble_sparse(spark, sf):
    """Every non-zero slot of every row, by name."""
    enc, s = _encoder(spark, sf)
    long = enc.encode(s, ["client_id"]).select("client_id", F.explode(F.arrays_zip("indices", "values")).alias("p"))
    named = long.join(enc.names(), F.col("p.indices") == F.col("slot"))
    return named.select("client_id", "feature", F.round("p.values", 6).alias("value")).where("value <> 0")


@register("level_dictionary", f"WITH {cat.BANK}, {cat._split_sql()}, {mq._KEPT_SQL} SELECT col AS \"column\", level FROM kept")
def q_level_dictionary(spark, sf):
    enc, _ = _encoder(spark, sf)
    return enc.dictionary.select("column", "level")


# a column with a level for nearly every row: the customers of the orders
_MANY = f"""{cat.PROSPECTS}, sp AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(prospect_id AS VARCHAR) || '-42'), prospect_id) AS rk,
    count(*) OVER (PARTITION BY y) AS cn FROM prospects), s AS (SELECT *, rk <= round(cn * {sql_double(0.7)}) AS train FROM sp),
    lv AS (SELECT DISTINCT cust_id FROM s WHERE train)"""


@register(
    "one_hot_many_levels",
    f"""WITH {_MANY} SELECT prospect_id, (SELECT count(*) FROM lv) AS size, CASE WHEN lv.cust_id IS NULL THEN NULL ELSE 'cust_id_' || s.cust_id END AS feature
    FROM s LEFT JOIN lv ON s.cust_id = lv.cust_id""",
)
def q_one_hot_many_levels(spark, sf):
    from leadlens.operators.encoding import fit_sparse_encoder

    s = stratified_split(ds.prospects(spark, sf).select("prospect_id", "cust_id", "y"), "prospect_id", "y")
    enc = fit_sparse_encoder(take_split(s, "train"), [], None, ["cust_id"])
    rows = enc.encode(s, ["prospect_id"]).select("prospect_id", "size", F.get("indices", F.lit(0)).alias("slot"))  # one column, so one slot at most
    return rows.join(enc.names(), "slot", "left").select("prospect_id", "size", "feature")


# ---------------------------------------------------------------------------
# ANOVA over every encoded slot, with p-values
# ---------------------------------------------------------------------------
# regularised incomplete beta function by its continued fraction (modified Lentz), 400 steps of two
_BETA = """list_reduce(list_prepend({'c': 1.0, 'd': 1.0 / (1.0 - (a + b) * x / (a + 1.0)), 'h': 1.0 / (1.0 - (a + b) * x / (a + 1.0)), 'm': 0.0},
      list_transform(range(1, 401), lambda i: {'c': 0.0, 'd': 0.0, 'h': 0.0, 'm': CAST(i AS DOUBLE)})), lambda p, q: {'m': q.m,
      'c': (1.0 + (-(a + q.m) * (a + b + q.m) * x / ((a + 2 * q.m) * (a + 2 * q.m + 1))) / (1.0 + (q.m * (b - q.m) * x / ((a + 2 * q.m - 1) * (a + 2 * q.m))) / p.c)),
      'd': 1.0 / (1.0 + (-(a + q.m) * (a + b + q.m) * x / ((a + 2 * q.m) * (a + 2 * q.m + 1))) / (1.0 + (q.m * (b - q.m) * x / ((a + 2 * q.m - 1) * (a + 2 * q.m))) * p.d)),
      'h': p.h * (1.0 / (1.0 + (q.m * (b - q.m) * x / ((a + 2 * q.m - 1) * (a + 2 * q.m))) * p.d)) * (1.0 + (q.m * (b - q.m) * x / ((a + 2 * q.m - 1) * (a + 2 * q.m))) / p.c)
        * (1.0 / (1.0 + (-(a + q.m) * (a + b + q.m) * x / ((a + 2 * q.m) * (a + 2 * q.m + 1))) / (1.0 + (q.m * (b - q.m) * x / ((a + 2 * q.m - 1) * (a + 2 * q.m))) * p.d)))
        * (1.0 + (-(a + q.m) * (a + b + q.m) * x / ((a + 2 * q.m) * (a + 2 * q.m + 1))) / (1.0 + (q.m * (b - q.m) * x / ((a + 2 * q.m - 1) * (a + 2 * q.m))) / p.c))}).h"""


@register(
    "anova_encoded",
    f"""WITH {_ENCODED_SQL}, tr AS (SELECT client_id, y FROM s WHERE split = 'train'), cls AS (SELECT y, CAST(count(*) AS DOUBLE) AS n FROM tr GROUP BY y),
    names AS (SELECT DISTINCT feature FROM v), g AS (SELECT feature, y, sum(value) AS s, sum(value * value) AS q FROM v JOIN tr USING (client_id) GROUP BY ALL),
    f AS (SELECT names.feature, cls.y, cls.n, coalesce(g.s, 0.0) AS s, coalesce(g.q, 0.0) AS q FROM names CROSS JOIN cls LEFT JOIN g ON g.feature = names.feature AND g.y = cls.y),
    t AS (SELECT feature, sum(n) AS n, sum(s) AS s, sum(q) AS q, sum(s * s / n) AS btw, count(*) AS k FROM f GROUP BY feature),
    r AS (SELECT feature, ((btw - s * s / n) / (k - 1)) / ((q - btw) / (n - k)) AS f_stat, n - k AS d2, CAST(k - 1 AS DOUBLE) AS d1 FROM t),
    u AS (SELECT *, d2 / (d2 + d1 * f_stat) < (d2 / 2 + 1) / (d2 / 2 + d1 / 2 + 2) AS low FROM r),
    w AS (SELECT *, CASE WHEN low THEN d2 / 2 ELSE d1 / 2 END AS a, CASE WHEN low THEN d1 / 2 ELSE d2 / 2 END AS b,
        CASE WHEN low THEN d2 / (d2 + d1 * f_stat) ELSE d1 * f_stat / (d2 + d1 * f_stat) END AS x FROM u),
    p AS (SELECT feature, f_stat, low, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1 - x)) * {_BETA} / a AS i FROM w)
    SELECT feature, f_stat, CASE WHEN low THEN i ELSE 1 - i END AS p_value FROM p""",
)
def q_anova_encoded(spark, sf):
    from leadlens.operators.features import build_pipeline, safe_name
    from leadlens.operators.train import anova_encoded, binary_columns, vector_names

    train = take_split(cat._bank_split(spark, sf), "train")
    safe = train.select(*[F.col(f"`{c}`").alias(safe_name(c)) for c in train.columns])
    encoder = build_pipeline(None, binary=binary_columns(safe, NOMINAL_FEATURES), n_rows=safe.count()).fit(safe)
    return anova_encoded(encoder.transform(safe), vector_names(encoder))


@register("fitted_attribution", f"WITH {mq._SLOTS_SQL} SELECT feature, true AS positive_mean, true AS adds_up FROM slots")
def q_fitted_attribution(spark, sf):
    """Mean absolute attribution per slot of a fitted model, and whether base and attributions add up to the margin on every test row."""
    from leadlens.operators.train import fit, fitted_attribution, vector_names

    train, test = mq._splits(spark, sf)
    model = fit(train, "logistic_regression")
    rows, base = fitted_attribution(model, test, "client_id", background=train)
    gap = F.abs(F.aggregate("attribution", F.lit(base), lambda s, v: s + v) - F.col("margin"))
    names = vector_names(model)
    worst = rows.agg(F.max(gap).alias("gap"), *[F.avg(F.abs(F.col("attribution")[i])).alias(f"a{i}") for i in range(len(names))])
    return worst.select(F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), (F.col(f"a{i}") >= 0).alias("positive_mean"), (F.col("gap") < 1e-9).alias("adds_up")) for i, n in enumerate(names)])))


# ---------------------------------------------------------------------------
# Mutual information of binned numerics, normalised
# ---------------------------------------------------------------------------
_MI_NUMS = ["age", "campaign", "previous", "euribor3m", "nr.employed"]
_MI_NOMS = list(NOMINAL_FEATURES)


def _bin_sql(c: str) -> str:
    x, w = f'CAST("{c}" AS DOUBLE)', f'((SELECT max(CAST("{c}" AS DOUBLE)) - min(CAST("{c}" AS DOUBLE)) FROM bank) / 10)'
    lo = f'(SELECT min(CAST("{c}" AS DOUBLE)) FROM bank)'
    return f"CAST(least(greatest(ceil(({x} - {lo}) / {w}), 1), 10) AS INTEGER)"


@register(
    "mutual_information_binned",
    f"""WITH {cat.BANK}, lng AS ({' UNION ALL '.join([f"SELECT '{c}' AS feature, CAST({_bin_sql(c)} AS VARCHAR) AS level, y FROM bank" for c in _MI_NUMS]
        + [f"SELECT '{c}' AS feature, CAST(\"{c}\" AS VARCHAR) AS level, y FROM bank" for c in _MI_NOMS])}),
    c AS (SELECT feature, level, y, count(*) AS n_xy FROM lng GROUP BY ALL),
    t AS (SELECT *, sum(n_xy) OVER (PARTITION BY feature) AS n, sum(n_xy) OVER (PARTITION BY feature, level) AS n_x, sum(n_xy) OVER (PARTITION BY feature, y) AS n_y FROM c),
    m AS (SELECT feature, sum(n_xy / n * ln(n_xy * n / (n_x * n_y))) AS mi FROM t GROUP BY feature) SELECT feature, mi / max(mi) OVER () AS mutual_info FROM m""",
)
def q_mutual_information_binned(spark, sf):
    from leadlens.operators.train import mutual_information

    binned = cat._bank(spark, sf)
    for c in _MI_NUMS:
        binned = pr.equal_width_bins(binned, c, 10, out=c)
    return mutual_information(binned, _MI_NUMS + _MI_NOMS, "y", normalise=True)


# ---------------------------------------------------------------------------
# The other threshold grids, strategies, winners
# ---------------------------------------------------------------------------
def _curve_sql(n: int, start: float, stop: float) -> str:
    return f"""WITH {cat.LEADS}, {cat._sweep_sql(cat._grid_sql(n, start, stop))}
    SELECT threshold, tp, fp, fn, tn, {cat._profit_sql()} AS net_profit, CASE WHEN tp+fn > 0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0.0 END AS recall,
           CASE WHEN tp+fp > 0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0.0 END AS precision, CASE WHEN fp+tn > 0 THEN CAST(fp AS DOUBLE)/(fp+tn) ELSE 0.0 END AS fpr FROM sw"""


@register("profit_curve_111", _curve_sql(111, 0.05, 0.60))
def q_profit_curve_111(spark, sf):
    return ev.profit_curve(ds.leads(spark, sf), "y", "score", start=0.05, stop=0.60, n_steps=111)


@register("profit_curve_120", _curve_sql(120, 0.01, 0.60))
def q_profit_curve_120(spark, sf):
    return ev.profit_curve(ds.leads(spark, sf), "y", "score", start=0.01, stop=0.60, n_steps=120)


@register(
    "strategy_compare_charged",
    f"""WITH {cat.SCORES}, tuned AS (SELECT * FROM scores WHERE stage = 'tuned'), {cat._opt_sql('tuned')},
    pm AS (SELECT model, {cat._conf_sql('score >= threshold')} FROM tuned JOIN opt USING (model) GROUP BY model), tot AS (SELECT max(tp + fn) AS p, max(fp + tn) AS n FROM pm),
    u AS (SELECT 'call_nobody' AS strategy, CAST(-200 * p AS DOUBLE) AS profit, CAST(0 AS BIGINT) AS calls, CAST(0 AS BIGINT) AS conversions FROM tot
          UNION ALL SELECT 'call_everybody', CAST(p * 195 - n * 5 AS DOUBLE), p + n, p FROM tot UNION ALL SELECT model, {cat._profit_sql()}, tp + fp, tp FROM pm)
    SELECT *, CASE WHEN calls > 0 THEN profit / calls ELSE 0.0 END AS profit_per_call FROM u""",
)
def q_strategy_compare_charged(spark, sf):
    """Calling nobody is charged for every missed subscriber."""
    tuned = ds.model_scores(spark, sf, ("tuned",))
    return ev.strategy_compare(tuned, ev.find_optimal_threshold(tuned, "y", "score", by="model"), "model", "y", "score", charge_missed=True)


@register(
    "wins_per_model",
    f"""WITH {cat._comparison_sql()}, lng AS ({cat._best_sql()}), b AS (SELECT model FROM (SELECT *, row_number() OVER (PARTITION BY criterion ORDER BY s DESC, model) AS rn FROM lng) WHERE rn = 1)
    SELECT model AS winner, count(*) AS wins FROM b GROUP BY model""",
)
def q_wins_per_model(spark, sf):
    return ev.wins_per_model(ev.best_per_criterion(cat.model_comparison(spark, sf)))


@register("tier_top_level", f"WITH {cat.LEADS}, p AS (WITH {cat._profile_sql(cat._tier_sql('score'), 'tier')}) SELECT tier, feature, level FROM p WHERE rank = 1")
def q_tier_top_level(spark, sf):
    from leadlens.operators.leads import fixed_tiers, tier_profile, top_level

    return top_level(tier_profile(fixed_tiers(cat._scored(spark, sf)), cat.PROFILE_FEATS))


# ---------------------------------------------------------------------------
# Cleaning: fits on the training rows, the other mode, its reports
# ---------------------------------------------------------------------------
_SPLIT_LEADS = cat._split_sql("leads", "lead_id")
_SPLIT_PROSPECTS = cat._split_sql("prospects", "prospect_id")


@register(
    "clip_outliers_train",
    f"WITH {cat.LEADS}, {_SPLIT_LEADS}, tr AS (SELECT * FROM s WHERE split = 'train') SELECT lead_id, " + ", ".join(f"{cat._clip_sql(c, 'tr')} AS {c}" for c in cat.LEAD_NUMS) + " FROM leads",
)
def q_clip_outliers_train(spark, sf):
    from leadlens.operators.clean import clip_outliers
    from leadlens.session import materialize

    rows = ds.leads(spark, sf).select("lead_id", "y", *cat.LEAD_NUMS)
    train = materialize(take_split(stratified_split(rows, "lead_id", "y"), "train").select(*cat.LEAD_NUMS))  # the quantiles take several passes
    return clip_outliers(rows, cat.LEAD_NUMS, fit_on=train).drop("y")


@register(
    "impute_mode_train",
    f"WITH {cat.PROSPECTS}, {_SPLIT_PROSPECTS}, tr AS (SELECT * FROM s WHERE split = 'train') SELECT prospect_id, "
    + ", ".join(f"CASE WHEN {c} = 'unknown' THEN {cat._mode_sql(c, 'tr')} ELSE {c} END AS {c}" for c in ("priority", "month"))
    + " FROM prospects",
)
def q_impute_mode_train(spark, sf):
    from leadlens.operators.clean import impute_mode

    rows = ds.prospects(spark, sf).select("prospect_id", "y", "priority", "month")
    return impute_mode(rows, ["priority", "month"], fit_on=take_split(stratified_split(rows, "prospect_id", "y"), "train")).drop("y")


def _clean_sql(drop: str) -> str:
    clip = ", ".join(f'{cat._clip_sql(x, "d")} AS {x}' for x in cat.CLEAN_CLIP)
    modes = ", ".join(f"CASE WHEN {x} = 'unknown' THEN {cat._mode_sql(x, 'c')} ELSE {x} END AS {x}" for x in ("priority", "month"))
    return f"""{cat.PROSPECTS}, d AS (SELECT DISTINCT {drop} FROM prospects), c AS (SELECT * REPLACE ({clip}) FROM d), z AS (SELECT * REPLACE ({modes}) FROM c)"""


@register("clean_data_exploratory", f"WITH {_clean_sql('*')} SELECT * FROM z")
def q_clean_data_exploratory(spark, sf):
    """``production=False``: the leakage column stays."""
    from leadlens.operators.clean import clean_data

    return clean_data(ds.prospects(spark, sf), production=False, leakage=["year"], outlier_cols=cat.CLEAN_CLIP, impute_cols=["priority", "month"])


_REPORT_NUMS = ["amount", "pdays", "previous"]


@register(
    "clean_reports",
    f"""WITH {_clean_sql('* EXCLUDE (year)')},
    n AS (SELECT 'missing' AS report, 'amount' AS "column", CAST(count(*) FILTER (WHERE amount IS NULL OR isnan(amount)) AS DOUBLE) AS value FROM prospects),
    k AS ({' UNION ALL '.join(f"SELECT 'levels' AS report, '{c}' AS column_, CAST(count(DISTINCT {c}) AS DOUBLE) AS value FROM d" for c in ('priority', 'month', 'day_of_week', 'status_code'))}),
    w AS ({' UNION ALL '.join(f"SELECT 'skewness' AS report, '{c}' AS column_, skewness(CAST({c} AS DOUBLE)) FILTER (WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))) AS value FROM c" for c in _REPORT_NUMS)}),
    r AS ({' UNION ALL '.join(f"SELECT 'correlation' AS report, '{a}~{b}' AS column_, abs(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) FILTER (WHERE NOT isnan(CAST({a} AS DOUBLE)) AND NOT isnan(CAST({b} AS DOUBLE)))) AS value FROM c" for a, b in (('amount', 'pdays'), ('amount', 'previous'), ('pdays', 'previous')))})
    SELECT report, "column", value FROM n UNION ALL SELECT report, column_, value FROM k UNION ALL SELECT report, column_, value FROM w
    UNION ALL SELECT report, column_, value FROM r""",
)
def q_clean_reports(spark, sf):
    from leadlens.operators.clean import clean_with_reports

    rows = ds.prospects(spark, sf)
    _, reports = clean_with_reports(rows, production=True, leakage=["year"], outlier_cols=cat.CLEAN_CLIP, impute_cols=["priority", "month"], numeric=_REPORT_NUMS, correlation_above=-1.0)
    return reports


# ---------------------------------------------------------------------------
# Schema and reports
# ---------------------------------------------------------------------------
@register(
    "conform_schema_warnings",
    f"""WITH {cat.BANK}, n AS (SELECT count(*) AS n FROM bank) SELECT * FROM (VALUES (0, 'Auto-dropped `duration`'), (1, 'Auto-dropped `y`'), (2, 'Dropped extra: [''client_id'']'),
    (3, 'Auto-filled missing columns with defaults: [''pdays'', ''previous'', ''poutcome'', ''cons.conf.idx'', ''euribor3m'', ''nr.employed'']')) w(at, warning)
    UNION ALL SELECT 4, 'Replaced ' || count(*) FILTER (WHERE age % 2 = 0) || ' NaN values with 0' FROM bank""".replace("w(at,", 'w("at",'),
)
def q_conform_schema_warnings(spark, sf):
    """The warnings themselves, on a table with gaps in a numeric column; nothing is still missing."""
    from leadlens.operators.schema import conform_schema

    messy = cat._messy(spark, sf)
    gaps = messy.withColumn("AGE", F.when(F.col("AGE") % 2 != 0, F.col("AGE")))
    _, warnings, missing = conform_schema(gaps)
    rows = list(enumerate(warnings)) + [(-1, f"missing: {missing}")] * bool(missing)
    return spark.createDataFrame(rows, "at int, warning string")


@register(
    "validate_shape_mismatch",
    f"WITH {cat.BANK} SELECT count(*) AS n_rows, CAST(21 AS INTEGER) AS n_cols, count(*) = 41188 AS shape_ok FROM bank",
)
def q_validate_shape_mismatch(spark, sf):
    """The raw file's own shape, which these tables do not have."""
    from leadlens.operators.schema import validate_shape
    from leadlens.sources.io import RAW_COLS, RAW_ROWS

    return validate_shape(cat._raw_bank(spark, sf), RAW_ROWS, RAW_COLS)


@register(
    "write_report_csv",
    f"WITH {cat._comparison_sql()} SELECT model, threshold, tp, fp, fn, tn, net_profit, row_number() OVER (ORDER BY net_profit DESC, model) AS place FROM cmp",
)
def q_write_report_csv(spark, sf):
    """The sorted comparison as CSV, read back."""
    from leadlens.operators.flow import rank_models
    from leadlens.session import scratch_path
    from leadlens.sources.io import write_report

    table = rank_models(cat.model_comparison(spark, sf)).select("model", "threshold", "tp", "fp", "fn", "tn", "net_profit", "place")
    path = write_report(table, scratch_path(spark, "comparison"), "csv")
    schema = "model string, threshold double, tp long, fp long, fn long, tn long, net_profit double, place long"
    return spark.read.schema(schema).option("header", True).csv(path)


# ---------------------------------------------------------------------------
# Scoring with a fitted model, and the stream with conformance on
# ---------------------------------------------------------------------------
@register(
    "batch_score_fitted",
    f"WITH {cat.BANK} SELECT count(*) AS n, true AS in_range, true AS verdicts_fit, true AS highest_first FROM bank",
)
def q_batch_score_fitted(spark, sf):
    """An uploaded table with other names and absent columns: conformed, scored by a fitted pipeline, ranked."""
    from pyspark.sql import Window

    from leadlens.operators.features import safe_name
    from leadlens.operators.leads import batch_score
    from leadlens.operators.schema import conform_schema
    from leadlens.operators.train import fit

    train, _ = mq._splits(spark, sf)
    upload, _, missing = conform_schema(cat._messy(spark, sf))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    out = batch_score(upload.select(*[F.col(f"`{c}`").alias(safe_name(c)) for c in upload.columns]), 0.3, model=fit(train, "logistic_regression"))
    p = F.col("probability")
    fits = F.when(F.abs(p - 0.3) > 1e-4, (p >= 0.3) == (F.col("verdict") == "YES")).otherwise(F.lit(True))
    placed = out.select("probability", "verdict", F.monotonically_increasing_id().alias("at"))
    # the order of the sorted rows, checked within each part of it (ids grow with the parts)
    part = Window.partitionBy(F.shiftright("at", 33)).orderBy("at")
    falls = F.coalesce(F.lag("probability").over(part) >= p, F.lit(True))
    checked = placed.withColumn("falls", falls)
    return checked.agg(
        F.count(F.lit(1)).alias("n"), F.every(p.between(0.0, 1.0)).alias("in_range"), F.every(fits).alias("verdicts_fit"), F.every("falls").alias("highest_first")
    )


@register(
    "score_stream_conformed",
    f"""WITH {cat.PROSPECTS}, c AS (SELECT prospect_id, CASE WHEN amount IS NULL OR isnan(amount) THEN 0 ELSE amount END AS amount, day_of_week FROM prospects),
    p AS (SELECT prospect_id, least(amount / 1000000.0 + CASE day_of_week WHEN 'mon' THEN 0.25 ELSE 0.0 END, 1.0) AS p FROM c)
    SELECT prospect_id, round(p, 4) AS probability, CASE WHEN p >= {sql_double(0.3)} THEN 'YES' ELSE 'NO' END AS verdict FROM p""",
)
def q_score_stream_conformed(spark, sf):
    """Files with other names, gaps and NaN, scored as they arrive: names and numerics are conformed in the stream."""
    from leadlens.session import scratch_path
    from leadlens.streaming.scoring import run_to_completion, score_stream

    source = scratch_path(spark, "uploads")
    files = ds.prospects(spark, sf).select("prospect_id", F.col("amount").alias("AMOUNT"), F.col("day_of_week").alias("DayOfWeek"))
    files.write.parquet(source)

    def scorer(df):
        monday = F.when(F.col("day_of_week") == "mon", 0.25).otherwise(0.0)
        p = F.least(F.col("amount") / 1000000.0 + monday, F.lit(1.0))
        return df.select(F.col("prospect_id").cast("long").alias("prospect_id"), p.alias("probability"))

    sink = scratch_path(spark, "scored-uploads")
    run_to_completion(score_stream(spark, source, files.schema, scorer, 0.3, sink, sanitise=True, keep=("prospect_id",)))
    return spark.read.parquet(sink)


# a score with nearly as many values as rows
_CONTINUOUS = f"{cat.LEADS}, cont AS (SELECT y, net_price / 200000.0 AS score FROM leads)"


def _continuous(spark, sf):
    return ds.leads(spark, sf).select("y", (F.col("net_price") / 200000.0).alias("score"))


@register("roc_auc_continuous", f"WITH {_CONTINUOUS}, {cat._rank_sql('cont')} SELECT roc_auc, pr_auc FROM r")
def q_roc_auc_continuous(spark, sf):
    return ev.compute_metrics(_continuous(spark, sf), "y", "score").select("roc_auc", "pr_auc")


@register(
    "find_optimal_threshold_continuous",
    f"WITH {_CONTINUOUS}, {cat._sweep_sql(cat._grid_sql(200, 0.05, 0.95), 'cont')} SELECT threshold, {cat._profit_sql()} AS net_profit FROM sw ORDER BY net_profit DESC, threshold LIMIT 1",
)
def q_find_optimal_threshold_continuous(spark, sf):
    return ev.find_optimal_threshold(_continuous(spark, sf), "y", "score")
