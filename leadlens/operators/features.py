"""Feature encoding, fit on the training rows only.

Two forms of the same encoders:

* expression form (``fit_*`` -> ``apply_*``): learned state is a handful of
  numbers / level lists, applied as plain column expressions — exact and
  SQL-checkable (population std, drop-first-if-binary one-hot, ordinal with
  -1 for unseen levels);
* MLlib form (``build_pipeline``): the same steps as ``pyspark.ml`` stages
  for training and persistence.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.functions.columns import quoted

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# ---------------------------------------------------------------------------
TARGET = "y"
EDUCATION_ORDER = [
    "illiterate",
    "basic.4y",
    "basic.6y",
    "basic.9y",
    "high.school",
    "professional.course",
    "university.degree",
    "unknown",
]
NOMINAL_FEATURES = ["job", "marital", "default", "housing", "loan", "contact", "month", "day_of_week", "poutcome"]
NUMERIC_FEATURES = [
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
POST_SENTINEL_NUMERIC = [c for c in NUMERIC_FEATURES if c != "pdays"] + ["was_previously_contacted", "pdays_log"]


def safe_name(name: str) -> str:
    return name.replace(".", "_").replace(" ", "_")


# ---------------------------------------------------------------------------
# Standard scaling (population std; constant column -> divisor 1)
# ---------------------------------------------------------------------------
def _known(col: str) -> Column:
    """The column as double; NaN is left out of statistics, as NULL is."""
    x = quoted(col).cast("double")
    return F.when(~F.isnan(x), x)


def fit_standard_scaler(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    if not columns:
        return {}
    row = train.agg(
        *[F.avg(_known(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(_known(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    out = {}
    for i, c in enumerate(columns):
        m, s = row[f"m{i}"], row[f"s{i}"]
        out[c] = (m if m is not None else 0.0, s if s else 1.0)
    return out


def scaled(col: str, mean: float, std: float) -> Column:
    return (quoted(col).cast("double") - F.lit(mean)) / F.lit(std)


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, prefix: str = "num__") -> DataFrame:
    stats = fit_standard_scaler(fit_on if fit_on is not None else df, columns)
    return df.withColumns({f"{prefix}{safe_name(c)}": scaled(c, m, s) for c, (m, s) in stats.items()})


# ---------------------------------------------------------------------------
# Ordinal encoding
# ---------------------------------------------------------------------------
def ordinal_code(col: str, order: Sequence[str] = tuple(EDUCATION_ORDER)) -> Column:
    """0-based position in ``order``; unseen or NULL -> -1."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), quoted(col))
    return F.coalesce(pos.cast("int") - 1, F.lit(-1))


def ordinal_encode(df: DataFrame, col: str = "education", order: Sequence[str] = tuple(EDUCATION_ORDER), prefix: str = "ord__") -> DataFrame:
    return df.withColumn(f"{prefix}{safe_name(col)}", ordinal_code(col, order))


# ---------------------------------------------------------------------------
# One-hot encoding
# ---------------------------------------------------------------------------
def fit_one_hot(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct levels per column (NULL excluded); only the level lists
    (bounded by the columns' cardinality) reach the driver."""
    from leadlens.operators.profile import level_counts

    rows = level_counts(train, columns).where(F.col("value").isNotNull()).select("column", "value").collect()
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        levels[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in levels.items()}


def one_hot_columns(levels: Mapping[str, Sequence[str]], prefix: str = "nom__") -> dict[str, Column]:
    """One 0/1 column per level; a binary column keeps only its second level;
    unseen levels give all zeros."""
    out = {}
    for c, lv in levels.items():
        kept = list(lv[1:]) if len(lv) == 2 else list(lv)
        for v in kept:
            out[f"{prefix}{safe_name(c)}_{safe_name(v)}"] = F.coalesce((quoted(c) == F.lit(v)).cast("int"), F.lit(0))
    return out


def one_hot(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, prefix: str = "nom__") -> DataFrame:
    return df.withColumns(one_hot_columns(fit_one_hot(fit_on if fit_on is not None else df, columns), prefix))


# ---------------------------------------------------------------------------
# Whole preprocessor in expression form
# ---------------------------------------------------------------------------
@dataclass
class Preprocessor:
    numeric: list[str]
    ordinal: str | None
    nominal: list[str]
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)
    order: list[str] = field(default_factory=lambda: list(EDUCATION_ORDER))

    def columns(self) -> dict[str, Column]:
        cols = {f"num__{safe_name(c)}": scaled(c, m, s) for c, (m, s) in self.scale.items()}
        if self.ordinal:
            cols[f"ord__{safe_name(self.ordinal)}"] = ordinal_code(self.ordinal, self.order).cast("double")
        cols.update({k: v.cast("double") for k, v in one_hot_columns(self.levels).items()})
        return cols

    def feature_names(self) -> list[str]:
        return list(self.columns())

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Feature columns only (remainder dropped), plus ``keep``."""
        return df.select(*[quoted(k) for k in keep], *[c.alias(n) for n, c in self.columns().items()])


def fit_preprocessor(
    train: DataFrame,
    numeric: Sequence[str],
    ordinal: str | None,
    nominal: Sequence[str],
    order: Sequence[str] = tuple(EDUCATION_ORDER),
) -> Preprocessor:
    return Preprocessor(
        list(numeric), ordinal, list(nominal), fit_standard_scaler(train, numeric), fit_one_hot(train, nominal) if nominal else {}, list(order)
    )


def assemble_features(df: DataFrame, pre: Preprocessor, out: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """Feature columns assembled into one ML vector (names kept in column metadata)."""
    from pyspark.ml.feature import VectorAssembler

    wide = pre.transform(df, keep)
    return VectorAssembler(inputCols=pre.feature_names(), outputCol=out, handleInvalid="keep").transform(wide).select(
        *[quoted(k) for k in keep], out
    )


# ---------------------------------------------------------------------------
# MLlib pipeline: sentinel -> encode -> assemble -> classifier
# ---------------------------------------------------------------------------
def build_pipeline(
    classifier,
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
    ordinal: str | None = "education",
    nominal: Sequence[str] = tuple(NOMINAL_FEATURES),
    sentinel_col: str | None = "pdays",
    order: Sequence[str] = tuple(EDUCATION_ORDER),
    scale: bool = True,
    binary: Sequence[str] = (),
    n_rows: int | None = None,
):
    """A ``pyspark.ml.Pipeline``: SQL sentinel split + ordinal code, string
    indexing (alphabetical) and one-hot (one slot per level, unseen levels all zeros; columns named in ``binary``
    have two levels and keep the second), assembly, scaling and the classifier (features -> ``features``, label -> ``label``).
    With ``n_rows``, the scaler divides by the population deviation, as the expression form does."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
    from pyspark.ml.linalg import Vectors

    nums = [safe_name(c) for c in numeric]
    selects = []
    if sentinel_col:
        s = safe_name(sentinel_col)
        nums = [c for c in nums if c != s] + ["was_previously_contacted", "pdays_log"]
        selects += [
            f"CAST({s} <> 999 AS INT) AS was_previously_contacted",
            f"CASE WHEN {s} <> 999 THEN log1p(CAST({s} AS DOUBLE)) ELSE 0.0 END AS pdays_log",
        ]
    if ordinal:
        arr = ", ".join(f"'{v}'" for v in order)
        selects.append(f"CAST(coalesce(array_position(array({arr}), {safe_name(ordinal)}) - 1, -1) AS DOUBLE) AS ord_{safe_name(ordinal)}")
    sql = SQLTransformer(statement=f"SELECT *, {', '.join(selects)} FROM __THIS__" if selects else "SELECT * FROM __THIS__")
    noms = [safe_name(c) for c in nominal]
    stages = [sql]
    if noms:
        stages.append(
            StringIndexer(
                inputCols=noms, outputCols=[f"{c}_idx" for c in noms], handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in noms], outputCols=[f"{c}_oh" for c in noms], handleInvalid="error", dropLast=True))  # the last is the indexer's slot of unseen levels
        stages += [VectorSlicer(inputCol=f"{safe_name(c)}_oh", outputCol=f"{safe_name(c)}_second", indices=[1]) for c in binary]
    stages.append(VectorAssembler(inputCols=nums, outputCol="num_vec", handleInvalid="keep"))
    if scale:
        sample = "num_sample" if n_rows and n_rows > 1 else "num_scaled"
        stages.append(StandardScaler(inputCol="num_vec", outputCol=sample, withMean=True, withStd=True))
        if sample == "num_sample":  # from the sample deviation to the population's
            stages.append(ElementwiseProduct(inputCol=sample, outputCol="num_scaled", scalingVec=Vectors.dense([(n_rows / (n_rows - 1)) ** 0.5] * len(nums))))
    parts = ["num_scaled" if scale else "num_vec"] + ([f"ord_{safe_name(ordinal)}"] if ordinal else []) + [f"{c}_second" if c in {safe_name(b) for b in binary} else f"{c}_oh" for c in noms]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="keep"))
    if classifier is not None:  # else the encoder alone
        stages.append(classifier)
    return Pipeline(stages=stages)

