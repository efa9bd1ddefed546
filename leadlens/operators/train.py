"""Training, tuning and importance with Spark MLlib.

* Class balance is a ``weightCol`` (n / (2 n_c)), joined from a per-class
  count table (one row per class).
* Tuning is a seeded random search over the reference's search spaces on a
  fold store (``folds``): features are written once per fold, only the
  classifiers are refitted, concurrently as Spark jobs.
* Evaluation of out-of-fold predictions reuses the distributed metric
  operators with ``by=[model, fold]``, so no prediction is collected.
* Permutation importance scores every (feature, repeat) variant in ONE
  transform + grouped AUC; the permutation partner of each row comes from a
  join on distributed hash ranks, not from a global ``row_number``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlens.functions.columns import quoted
from leadlens.operators import evaluate as ev
from leadlens.operators.features import NOMINAL_FEATURES, NUMERIC_FEATURES, build_pipeline, safe_name

SEED = 42
RANKED_ROWS = 100_000  # of one permuted variant that are ranked in one task
PARALLELISM = 4  # concurrent fold/model fits (Spark jobs submitted from driver threads)
MODEL_NAMES = ["logistic_regression", "random_forest", "gradient_boosting", "linear_svc"]


def _parallel(fn, items, parallelism: int = PARALLELISM) -> list:
    """Run independent fits concurrently; each is its own Spark job, the
    scheduler interleaves their tasks on the executors."""
    from concurrent.futures import ThreadPoolExecutor

    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return list(pool.map(fn, items))


# ---------------------------------------------------------------------------
# Class weights
# ---------------------------------------------------------------------------
def class_weights(df: DataFrame, target: str = "y") -> DataFrame:
    """Per class: rows, balanced weight n/(2 n_c), and round(neg/pos, 2)."""
    c = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # one row per class: bounded
    neg = F.sum(F.when(F.col(target) == 0, F.col("n"))).over(w)
    pos = F.sum(F.when(F.col(target) == 1, F.col("n"))).over(w)
    return c.select(
        target,
        "n",
        (F.sum("n").over(w) / (F.lit(2.0) * F.col("n"))).alias("weight"),
        F.round(neg.cast("double") / pos, 2).alias("scale_pos_weight"),
    )


def _join_weights(df: DataFrame, weights: DataFrame, target: str) -> DataFrame:
    """One row per class is broadcast; rows without a target keep their place (and make a fit fail loudly)."""
    w = weights.withColumnRenamed(target, "_wt")
    return df.join(F.broadcast(w), F.col(target).eqNullSafe(F.col("_wt")), "left").drop("_wt")


def with_balanced_weights(df: DataFrame, target: str = "y", out: str = "weight") -> DataFrame:
    cw = class_weights(df, target).select(target, F.col("weight").alias(out))
    return _join_weights(df, cw, target)


def with_pos_weight(df: DataFrame, target: str = "y", out: str = "weight") -> DataFrame:
    """Positive rows weighted by round(neg/pos, 2) (the boosted-tree convention)."""
    cw = class_weights(df, target).select(
        target, F.when(F.col(target) == 1, F.col("scale_pos_weight")).otherwise(F.lit(1.0)).alias(out)
    )
    return _join_weights(df, cw, target)


# ---------------------------------------------------------------------------
# Classifiers
# ---------------------------------------------------------------------------
MOST_LEVELS = 30  # MLlib's trees; what an unlimited depth comes to
#: Boosted trees of so many levels are gone down anew at each level, without cached node ids.
FEW_LEVELS = 8


def _depth(depth) -> int:
    if int(depth) > MOST_LEVELS:
        raise ValueError("MLlib trees have at most 30 levels")
    return int(depth)


def make_classifier(name: str, params: Mapping | None = None, n_rows: int | None = None, weight_col: str | None = "weight"):
    """A ``pyspark.ml`` classifier for a reference model name and its params."""
    from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier

    p = dict(params or {})
    common = {"featuresCol": "features", "labelCol": "label"}
    if weight_col:
        common["weightCol"] = weight_col
    if name == "logistic_regression":
        C = float(p.get("C", 1.0))
        n = float(n_rows or 1)
        return LogisticRegression(
            regParam=1.0 / (C * n),
            elasticNetParam=1.0 if p.get("penalty", "l2") == "l1" else 0.0,
            standardization=False,
            maxIter=int(p.get("max_iter", 2000)),  # the tolerance stops it
            tol=float(p.get("tol", 1e-4)),  # the reference solver's stopping tolerance
            **common,
        )
    if name == "random_forest":
        return RandomForestClassifier(
            numTrees=int(p.get("n_estimators", 100)),
            maxDepth=MOST_LEVELS if p.get("max_depth", 5) is None else _depth(p.get("max_depth", 5)),
            minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
            seed=SEED,
            # deep forests: more nodes split per pass over the data, node ids cached
            maxMemoryInMB=int(p.get("max_memory_mb", 1024)),
            cacheNodeIds=True,
            **common,
        )
    if name == "gradient_boosting":
        return GBTClassifier(
            maxIter=int(p.get("n_estimators", 20)),
            maxDepth=_depth(p.get("max_depth", 5)),
            stepSize=float(p.get("learning_rate", 0.1)),
            subsamplingRate=float(p.get("subsample", 1.0)),
            featureSubsetStrategy=str(p.get("colsample_bytree", "all")),
            seed=SEED,
            maxMemoryInMB=int(p.get("max_memory_mb", 1024)),
            cacheNodeIds=int(p.get("max_depth", 5)) > FEW_LEVELS,
            **common,
        )
    if name == "linear_svc":
        reg = 1.0 / (float(p["C"]) * float(n_rows or 1)) if "C" in p else float(p.get("reg", 0.01))
        return LinearSVC(regParam=reg, maxIter=int(p.get("max_iter", 2000)), tol=float(p.get("tol", 1e-4)), **common)
    raise ValueError(f"Unknown model name: {name!r}")


def prepare(df: DataFrame, target: str = "y", weights: str = "balanced", spread: bool = True) -> DataFrame:
    """Rename dotted columns, add ``label`` and the class weight column.

    Rows are dealt by a hash of their values to ``spark.sql.shuffle.partitions``: bagging and float sums follow the rows, not the
    way they arrived."""
    out = df.select(*[quoted(c).alias(safe_name(c)) for c in df.columns]).withColumn("label", F.col(target).cast("double"))
    if spread:
        out = out.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*out.columns))
    if weights == "balanced":
        return with_balanced_weights(out, target)
    if weights == "pos":
        return with_pos_weight(out, target)
    return out.withColumn("weight", F.lit(1.0))


def binary_columns(df: DataFrame, nominal: Sequence[str]) -> list[str]:
    """The nominal columns with exactly two levels: least and greatest differ and nothing lies between.  Two plain aggregates, which shuffle one row a task."""
    if not nominal:
        return []
    cols = [quoted(safe_name(c)) for c in nominal]
    ends = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), (F.min(c) < F.max(c)).alias("differ")).alias(f"e{i}") for i, c in enumerate(cols)]).first()
    some = [i for i in range(len(cols)) if ends[f"e{i}"]["differ"]]
    if not some:
        return []
    between = lambda i: (cols[i] > F.lit(ends[f"e{i}"]["lo"])) & (cols[i] < F.lit(ends[f"e{i}"]["hi"]))
    row = df.agg(*[F.count(F.when(between(i), 1)).alias(f"n{i}") for i in some]).first()
    return [nominal[i] for i in some if row[f"n{i}"] == 0]


#: A classifier's rows lie in as many partitions as there are cores, and at least so many; in more only for so many rows each.
FIT_PARTS, FIT_ROWS = 8, 1_000_000


#: Fits of more rows run one after the other: each fills the cores by itself, and the rows that all of them keep would fill the memory.
ALONE_ROWS = 8_000_000


def fits_at_once(n: int, parallelism: int = PARALLELISM) -> int:
    """How many fits of ``n`` rows may run at a time."""
    return 1 if n > ALONE_ROWS else parallelism


def fit_rows(encoded: DataFrame, n: int) -> DataFrame:
    """``n`` encoded rows in no more partitions than a fit needs.  Each pass of MLlib's trees makes and shuffles the statistics of all nodes it splits
    (up to ``maxMemoryInMB``) once per partition, however few rows it holds, so that spare partitions multiply the work of a deep forest."""
    most = max(FIT_PARTS, encoded.sparkSession.sparkContext.defaultParallelism, math.ceil(n / FIT_ROWS))
    if encoded.rdd.getNumPartitions() <= most:
        return encoded
    return encoded.repartition(most, F.xxhash64(*encoded.columns))


def fit(
    train: DataFrame,
    name: str,
    params: Mapping | None = None,
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
    nominal: Sequence[str] = tuple(NOMINAL_FEATURES),
    ordinal: str | None = "education",
    target: str = "y",
):
    """Fit sentinel -> encode -> classifier on the training rows (PipelineModel)."""
    from pyspark.ml import PipelineModel

    # fits scan their input many times: the rows are kept for the encoder's fit only, then the encoded rows for the classifier's
    prepared = prepare(train, target, "pos" if name == "gradient_boosting" else "balanced").persist()
    encoded = None
    try:
        n = prepared.count()
        encoder = build_pipeline(None, numeric, ordinal, nominal, binary=binary_columns(prepared, nominal), n_rows=n).fit(prepared)
        encoded = fit_rows(encoder.transform(prepared).select("label", "weight", "features"), n).persist()
        encoded.count()
        prepared.unpersist()
        return PipelineModel(stages=[*encoder.stages, make_classifier(name, params, n, "weight").fit(encoded)])
    finally:
        prepared.unpersist()
        if encoded is not None:
            encoded.unpersist()


def score(model, df: DataFrame, keep: Sequence[str] = ("y",), prob: str = "probability") -> DataFrame:
    """Positive-class probability (or the raw margin for margin-only models)."""
    from pyspark.ml.functions import vector_to_array

    renamed = df.select(*[quoted(c).alias(safe_name(c)) for c in df.columns])
    out = model.transform(renamed)
    if "probability" in out.columns:
        p = vector_to_array(F.col("probability"))[1]
    else:
        p = vector_to_array(F.col("rawPrediction"))[1]
    return out.select(*[safe_name(k) for k in keep], p.alias(prob))


# ---------------------------------------------------------------------------
# Baselines, tuning, final model
# ---------------------------------------------------------------------------
# The default configurations that tuning is compared with.
BASELINES = {
    "logistic_regression": {"C": 1.0, "penalty": "l2", "max_iter": 2000},
    "random_forest": {"n_estimators": 100, "max_depth": None},
    "gradient_boosting": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3},
    "knn": {"k": 11, "weights": "uniform"},
}


def baseline_models(train: DataFrame, test: DataFrame, key: str, names: Sequence[str] = tuple(BASELINES), target: str = "y") -> DataFrame:
    """Default configurations (``BASELINES``) at threshold 0.5: metrics and net profit per model, in one grouped evaluation of written scores."""
    from leadlens.operators.features import POST_SENTINEL_NUMERIC
    from leadlens.operators.flow import neighbours
    from leadlens.functions.columns import sentinel_split
    from leadlens.session import materialize

    def one(name: str) -> DataFrame:
        if name == "knn":
            scorer = neighbours(numeric=POST_SENTINEL_NUMERIC, ordinal="education", nominal=NOMINAL_FEATURES, target=target, **BASELINES[name])
            scored = scorer(sentinel_split(train, "pdays"), sentinel_split(test, "pdays"), key).join(test.select(key, target), key)
        else:
            scored = score(fit(train, name, BASELINES[name], target=target), test, keep=[key, target])
        return scored.select(key, target, "probability").withColumn("model", F.lit(name))

    parts = _parallel(one, names, fits_at_once(train.count()))
    scored = parts[0]
    for p_ in parts[1:]:
        scored = scored.unionByName(p_)
    judged = ev.compute_metrics(materialize(scored, "baseline_scores"), target, "probability", 0.5, by="model", counts=True)
    return judged.withColumn("net_profit", ev.profit_expr(F.col("tp"), F.col("fp"), F.col("fn")).cast("double"))


def search_space(name: str, rng: np.random.RandomState) -> dict:
    """One random draw from the reference's search space of ``name``, but for what MLlib has no counterpart of (the least rows to split a
    node, penalties on leaves)."""
    if name == "logistic_regression":
        return {"C": float(math.exp(rng.uniform(math.log(1e-4), math.log(10.0)))), "penalty": str(rng.choice(["l1", "l2"]))}
    if name == "random_forest":
        return {
            "n_estimators": int(rng.choice(range(100, 601, 100))),
            "max_depth": int(rng.randint(4, 19)),
            "min_samples_leaf": int(rng.randint(2, 16)),
        }
    if name == "gradient_boosting":
        return {
            "n_estimators": int(rng.choice(range(100, 801, 100))),
            "max_depth": int(rng.randint(3, 10)),
            "learning_rate": float(math.exp(rng.uniform(math.log(0.01), math.log(0.3)))),
            "subsample": float(rng.uniform(0.6, 1.0)),
            "colsample_bytree": str(round(float(rng.uniform(0.6, 1.0)), 2)),
        }
    if name == "linear_svc":
        return {"reg": float(math.exp(rng.uniform(math.log(1e-4), math.log(1.0))))}
    raise ValueError(name)


def tune_model(train_with_folds: DataFrame, name: str, key: str, n_trials: int = 30, seed: int = SEED, parallelism: int = 4, fold_col: str = "fold") -> DataFrame:
    """Random search maximising the mean CV ROC-AUC; one row per trial (params as JSON, mean and population deviation of the AUC,
    is_best).  Folds come from ``stratified_kfold``; see ``folds.tune_on_folds`` for the scores themselves."""
    from leadlens.operators.folds import tune_on_folds, write_folds

    return tune_on_folds(write_folds(train_with_folds, key, fold_col), name, n_trials, seed, parallelism=parallelism)[0]


def best_params(trials: DataFrame) -> dict:
    import json

    row = trials.where("is_best").first()
    return json.loads(row["params"]) if row else {}


def train_final_model(train: DataFrame, name: str, params: Mapping):
    return fit(train, name, params)


def cv_compare(train_with_folds: DataFrame, names: Sequence[str], key: str, fold_col: str = "fold", params: Mapping | None = None) -> DataFrame:
    """Per model: mean and population std over folds of AUC, PR-AUC, F1, recall (threshold 0.5)."""
    from leadlens.operators.folds import compare_on_folds, write_folds

    return compare_on_folds(write_folds(train_with_folds, key, fold_col), names, params)


# ---------------------------------------------------------------------------
# Importance and attribution
# ---------------------------------------------------------------------------
def fold_importance(train_with_folds: DataFrame, k: int = 5, fold_col: str = "fold", n_trees: int = 300, depth: int = 12) -> DataFrame:
    """RF importances fitted on each training fold, averaged per feature (sorted).
    Only the importance vectors (#features numbers per fold) reach the driver."""
    spark = train_with_folds.sparkSession

    def one(f: int) -> list:
        m = fit(train_with_folds.where(F.col(fold_col) != f).drop(fold_col), "random_forest", {"n_estimators": n_trees, "max_depth": depth})
        names = vector_names(m)
        imp = m.stages[-1].featureImportances.toArray()
        return [(f, name, float(v)) for name, v in zip(names, imp, strict=True)]

    rows = [r for part in _parallel(one, range(k), fits_at_once(train_with_folds.count())) for r in part]
    df = spark.createDataFrame(rows, "fold int, feature string, importance double")
    return df.groupBy("feature").agg(F.avg("importance").alias("importance"), F.stddev_pop("importance").alias("importance_std")).orderBy(
        F.desc("importance"), F.asc("feature")
    )


def vector_names(model) -> list[str]:
    """Slot names of the final feature vector, read from the fitted stages:
    numeric inputs, the ordinal code, then one slot per indexed level."""
    stages = model.stages
    assemblers = [st for st in stages if st.__class__.__name__ == "VectorAssembler"]
    nums = assemblers[0].getInputCols()
    indexer = next((st for st in stages if st.__class__.__name__ == "StringIndexerModel"), None)
    labels = dict(zip(indexer.getInputCols(), indexer.labelsArray)) if indexer is not None else {}
    names: list[str] = []
    for part in assemblers[-1].getInputCols():
        if part in ("num_scaled", "num_vec"):
            names += list(nums)
        elif part.endswith("_second"):
            col = part[: -len("_second")]
            names.append(f"{col}_{labels[col][1]}")
        elif part.endswith("_oh"):
            col = part[: -len("_oh")]
            names += [f"{col}_{lv}" for lv in labels.get(col, [])]
        else:
            names.append(part)
    slots = getattr(stages[-1], "numFeatures", None)
    if slots is not None and slots >= 0 and slots != len(names):
        raise ValueError(f"{len(names)} names for {slots} features")
    return names


def distributed_rank(df: DataFrame, key: str, seed: int, out: str = "rank") -> DataFrame:
    """Global rank (1..n) in md5 hash order, computed in two levels (see split.class_rank)."""
    from leadlens.operators.split import class_rank

    return class_rank(df.withColumn("_all", F.lit(0)), key, "_all", seed).drop("_all", "_h", "class_n").withColumnRenamed("class_rank", out)


def feature_slots(names: Sequence[str], features: Sequence[str]) -> dict[str, list[int]]:
    """The slots of the encoded vector that come from each input column."""
    out = {}
    for f in features:
        s = safe_name(f)
        own = {s, f"ord_{s}"} | ({"was_previously_contacted", "pdays_log"} if s == "pdays" else set())
        others = [safe_name(g) for g in features if len(safe_name(g)) > len(s) and safe_name(g).startswith(s + "_")]
        out[f] = [
            i for i, n in enumerate(names) if n in own or (n.startswith(s + "_") and not any(n == o or n.startswith(o + "_") for o in others))
        ]
        if not out[f]:
            raise ValueError(f"no slots of {f!r}")
    return out


def permutation_importance(
    model, df: DataFrame, key: str, features: Sequence[str], repeats: int = 10, seed: int = SEED, target: str = "y"
) -> DataFrame:
    """Mean and std of the ROC-AUC drop when one feature is shuffled.

    Rows are encoded once.  Repeat r is a permutation: the row of hash rank i under ``seed`` takes the feature of the row of rank i under
    hash(key, r).  What travels to meet a partner is its share of the margin per feature for linear models (the margin is updated), and its encoded
    slots for others (the slots are exchanged); raw rows and encoders are not needed again.  All variants are scored in one grouped AUC (``ranking.roc_aucs``)."""
    from leadlens.operators.model_table import encode
    from leadlens.operators.ranking import roc_aucs
    from leadlens.operators.split import class_rank
    from leadlens.session import materialize

    names, last = vector_names(model), model.stages[-1]
    slots = feature_slots(names, features)
    x = encode(model, df, [key, target]).select(F.col(safe_name(key)).alias("_k"), F.col(safe_name(target)).cast("int").alias("_y"), "x")
    linear = hasattr(last, "coefficients")
    if linear:
        coef = last.coefficients.toArray()
        part = lambda idx: sum((F.col("x")[i] * F.lit(float(coef[i])) for i in idx), F.lit(0.0))
        whole = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(c)) for c in coef]), lambda a, b: a * b), F.lit(float(last.intercept)), lambda s, v: s + v)
        x = x.select("_k", "_y", whole.alias("_margin"), F.array(*[part(slots[f]) for f in features]).alias("x"))
    x = materialize(x, "permutation_rows")
    base = distributed_rank(x, "_k", seed, "_rank")

    def permuted(reps: Sequence[int]) -> DataFrame:
        """The base rows (met once, whatever the number of repeats) beside the partner's share in each of ``reps``."""
        each = F.explode(F.array(*[F.lit(r) for r in reps])).alias("_r")
        partner = class_rank(x.select("_k", F.col("x").alias("_px"), each), ["_k", "_r"], "_r", seed).select("_r", F.col("class_rank").alias("_rank"), "_px")
        return base.join(partner, "_rank")

    if linear:
        moved = [F.col("_margin") - F.col("x")[i] + F.col("_px")[i] for i in range(len(features))]
        names, by = list(features), ["_r"]
        scored = lambda reps: permuted(reps).select("_r", "_y", F.array(*moved).alias("scores"))
        own = x.select("_y", F.col("_margin").alias("score"))
    else:
        from pyspark.ml.functions import array_to_vector, vector_to_array

        def swapped(f):
            mine = set(slots[f])
            return F.struct(F.lit(f).alias("feature"), F.array(*[F.col("_px" if i in mine else "x")[i] for i in range(len(places))]).alias("v"))

        def scores(rows: DataFrame) -> DataFrame:
            out = last.transform(rows.withColumn("features", array_to_vector("v")))
            return out.withColumn("score", vector_to_array("probability" if "probability" in out.columns else "rawPrediction")[1])

        places, names, by = names, ["score"], ["feature", "_r"]
        scored = lambda reps: scores(permuted(reps).select("_r", "_y", F.inline(F.array(*[swapped(f) for f in features])))).select(*by, "_y", F.array("score").alias("scores"))
        own = scores(x.select("_y", F.col("x").alias("v"))).select("_y", "score")
    base_auc = ev.roc_auc(own, "_y", "score").first()["roc_auc"]
    # the repeats' scores are spread alike, so that the ranges of one serve all
    ranges = max(8, -(-x.count() // RANKED_ROWS))
    cuts = ev.score_ranges(scored([0]).select(F.explode("scores").alias("score")), "score", ranges)
    aucs = roc_aucs(scored(range(repeats)), names, cuts, "_y", "scores", by, "feature" if linear else "variant")
    drops = aucs.select("feature", (F.lit(base_auc) - F.col("roc_auc")).alias("drop"))
    return drops.groupBy("feature").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std")).orderBy(
        F.desc("importance_mean"), F.asc("feature")
    )


def mutual_information(df: DataFrame, features: Sequence[str], target: str = "y", normalise: bool = False) -> DataFrame:
    """Discrete mutual information (nats) between each feature's levels and the
    target, from one contingency aggregate.  ``normalise`` divides by the max."""
    long = df.select(
        F.col(target).cast("int").alias("_y"),
        F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), quoted(f).cast("string").alias("level")) for f in features])),
    )
    cnt = long.groupBy("feature", "level", "_y").agg(F.count(F.lit(1)).alias("n_xy"))
    # a feature may have very many levels: its totals per class are few rows and broadcast, level totals stay with the level
    wx = Window.partitionBy("feature", "level")  # as many rows as classes
    by_class = cnt.groupBy("feature", "_y").agg(F.sum("n_xy").alias("n_y"))
    whole = by_class.groupBy("feature").agg(F.sum("n_y").alias("n"))
    totals = by_class.join(whole, "feature").withColumnsRenamed({"feature": "_f", "_y": "_c"})
    t = cnt.withColumn("n_x", F.sum("n_xy").over(wx)).join(F.broadcast(totals), (F.col("feature") == F.col("_f")) & F.col("_y").eqNullSafe(F.col("_c")))
    term = F.col("n_xy") / F.col("n") * F.log(F.col("n_xy") * F.col("n") / (F.col("n_x") * F.col("n_y")))
    mi = t.groupBy("feature").agg(F.sum(term).alias("mutual_info"))
    if normalise:
        mi = mi.withColumn("mutual_info", F.col("mutual_info") / F.max("mutual_info").over(Window.partitionBy()))
    return mi


def anova_f(df: DataFrame, features: Sequence[str], target: str = "y") -> DataFrame:
    """One-way ANOVA F of each numeric feature across target classes, from
    per-class count / sum / sum of squares (one grouped aggregate)."""
    long = df.select(
        F.col(target).alias("_g"),
        F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), quoted(f).cast("double").alias("x")) for f in features])),
    ).where(F.col("x").isNotNull() & ~F.isnan("x"))
    g = long.groupBy("feature", "_g").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("ss"))
    tot = g.groupBy("feature").agg(
        F.sum("n").alias("N"),
        F.sum("s").alias("S"),
        F.sum("ss").alias("SS"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between_raw"),
    )
    ssb = F.col("between_raw") - F.col("S") * F.col("S") / F.col("N")
    ssw = F.col("SS") - F.col("between_raw")
    return tot.select(
        "feature",
        F.when((F.col("k") > 1) & (F.col("N") > F.col("k")) & (ssw > 0), (ssb / (F.col("k") - 1)) / (ssw / (F.col("N") - F.col("k")))).alias("f_stat"),
    )


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, for x below (a + 1) / (a + b + 2)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        for up in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + up * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + up / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def f_survival(f: float | None, d1: float, d2: float) -> float | None:
    """P(F >= f) of the F distribution with d1 and d2 degrees of freedom, by the incomplete beta function."""
    if f is None or f != f:
        return None
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    x, a, b = d2 / (d2 + d1 * f), d2 / 2.0, d1 / 2.0  # P = I_x(a, b)
    y = d1 * f / (d2 + d1 * f)  # 1 - x without cancellation
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(y))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, y) / b


def anova_encoded(df: DataFrame, names: Sequence[str], vector: str = "features", target: str = "y") -> DataFrame:
    """(feature, f_stat, p_value) of every slot of an encoded vector across the target's classes.

    One vector aggregate per class (count, sum, norm); a few numbers per slot and class reach the driver.  Rows without a target are left out; a slot
    without spread within the classes has no F, and no p-value.
    """
    from pyspark.ml.stat import Summarizer

    stats = Summarizer.metrics("count", "sum", "normL2")
    rows = df.where(F.col(target).isNotNull()).groupBy(target).agg(stats.summary(F.col(vector)).alias("s")).select("s.count", "s.sum", "s.normL2").collect()
    n = np.array([float(r["count"]) for r in rows])
    out = []
    if rows:
        sums, squares = np.array([r["sum"].toArray() for r in rows]), np.array([r["normL2"].toArray() ** 2 for r in rows])
        between = (sums**2 / n[:, None]).sum(axis=0)
        ssb, ssw = between - sums.sum(axis=0) ** 2 / n.sum(), squares.sum(axis=0) - between
        d1, d2 = float(len(rows) - 1), float(n.sum()) - len(rows)
        for i, name in enumerate(names):
            f = float((ssb[i] / d1) / (ssw[i] / d2)) if d1 > 0 and d2 > 0 and ssw[i] > 1e-12 * max(1.0, squares[:, i].sum()) else None
            out.append((name, f, f_survival(f, d1, d2)))
    return df.sparkSession.createDataFrame(out, "feature string, f_stat double, p_value double")


def fitted_attribution(model, df: DataFrame, key: str, background: DataFrame | None = None) -> tuple[DataFrame, float]:
    """(key, attribution array by slot, margin) of every row for a fitted linear pipeline, and the base margin.

    Exact SHAP values of the linear model: coefficient times the slot's distance from its mean over ``background`` (the rows themselves if
    none); base and attributions add up to the row's margin."""
    from leadlens.operators.model_table import encode

    last = model.stages[-1]
    coef = last.coefficients.toArray()
    x = encode(model, df, [key])
    ground = x if background is None else encode(model, background, [key])
    means = ground.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(coef))]).first()
    means = [means[f"m{i}"] or 0.0 for i in range(len(coef))]
    shares = F.array(*[F.lit(float(c)) * (F.col("x")[i] - F.lit(m)) for i, (c, m) in enumerate(zip(coef, means))])
    margin = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(c)) for c in coef]), lambda a, b: a * b), F.lit(float(last.intercept)), lambda s, v: s + v)
    return x.select(F.col(safe_name(key)).alias(key), shares.alias("attribution"), margin.alias("margin")), float(last.intercept + np.dot(coef, means))


def linear_attribution(df: DataFrame, coefs: Mapping[str, float], means: Mapping[str, float] | None = None, top: int | None = None) -> DataFrame:
    """Exact SHAP values of a linear model, coef * (x - mean), for ALL rows;
    returns mean |attribution| per feature (top ``top``)."""
    cols = list(coefs)
    if means is None:
        row = df.agg(*[F.avg(quoted(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
        means = {c: row[f"m{i}"] for i, c in enumerate(cols)}
    agg = df.agg(
        *[F.avg(F.abs(F.lit(float(coefs[c])) * (quoted(c).cast("double") - F.lit(float(means[c]))))).alias(f"a{i}") for i, c in enumerate(cols)]
    )
    out = agg.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias("mean_abs_attribution")) for i, c in enumerate(cols)])))
    out = out.orderBy(F.desc("mean_abs_attribution"), F.asc("feature"))
    return out.limit(top) if top else out


def local_cases(df: DataFrame, key: str, prob: str = "probability", target: str = "y", near: float = 0.30) -> DataFrame:
    """Rows worth explaining: highest and lowest probability, closest to ``near``,
    first true positive (p >= .5) and first true negative (p <= .1); key breaks ties.
    One aggregate of ``min_by`` over (ordering, key) structs."""
    p = F.col(prob).cast("double")
    k = F.col(key)
    y = F.col(target).cast("int")
    agg = df.agg(
        F.min_by(k, F.struct(-p, k)).alias("max_prob"),
        F.min_by(k, F.struct(p, k)).alias("min_prob"),
        F.min_by(k, F.struct(F.abs(p - F.lit(near)), k)).alias("near_threshold"),
        F.min(F.when((p >= 0.5) & (y == 1), k)).alias("first_tp"),
        F.min(F.when((p <= 0.1) & (y == 0), k)).alias("first_tn"),
    )
    return agg.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("case"), F.col(c).alias(key)) for c in ("max_prob", "min_prob", "near_threshold", "first_tp", "first_tn")]
            )
        )
    )


def feature_subset_sweep(
    train_with_folds: DataFrame, importance: DataFrame, key: str, ks: Sequence[int] = (5, 10, 15, 20, 30), fold_col: str = "fold", params: Mapping | None = None
) -> DataFrame:
    """CV ROC-AUC (mean and population std) of a random forest on the top-k features (by ``importance``) for each k and for all."""
    from leadlens.operators.folds import subset_sweep, write_folds

    ranked = [r["feature"] for r in importance.orderBy(F.desc("importance"), F.asc("feature")).collect()]  # slots of the encoder
    return subset_sweep(write_folds(train_with_folds, key, fold_col), ranked, ks, params=params)


def calibrated_svc(train_with_folds: DataFrame, rows: DataFrame, key: str, fold_col: str = "fold", k: int = 5, C: float = 1.0, target: str = "y") -> DataFrame:
    """(key, target, probability): mean of ``k`` linear SVMs, each fitted without one fold (classes balanced) and calibrated on that fold by isotonic
    regression.  Margins are written; the calibration runs in blocks (``isotonic``)."""
    from leadlens.operators.isotonic import calibrated, isotonic_pools
    from leadlens.session import materialize

    def one(f: int) -> tuple[DataFrame, DataFrame]:
        model = fit(train_with_folds.where(F.col(fold_col) != f).drop(fold_col), "linear_svc", {"C": C}, target=target)
        held = train_with_folds.where(F.col(fold_col) == f).drop(fold_col)
        return tuple(score(model, d, keep=[key, target], prob="margin").withColumn("_model", F.lit(f)) for d in (held, rows))

    parts = _parallel(one, range(k), fits_at_once(train_with_folds.count()))
    held, asked = parts[0]
    for h, a in parts[1:]:
        held, asked = held.unionByName(h), asked.unionByName(a)
    held = materialize(held, "held_margins")  # read for the ranges and for the pools
    pools = materialize(isotonic_pools(held, "margin", target, by=["_model"]), "isotonic_pools")
    each = calibrated(materialize(asked, "svc_margins"), pools, "margin", by=["_model"])
    return each.groupBy(key, target).agg(F.avg("probability").alias("probability"))
