"""Schema handling for uploaded customer files: name normalisation and conformance.

All of this is driver-side work on the *schema* (a few dozen names) plus one
projection; no data passes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.functions.columns import quoted, sanitised

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# ---------------------------------------------------------------------------
FEATURES = [
    "age", "job", "marital", "education", "default", "housing", "loan",
    "contact", "month", "day_of_week", "campaign", "pdays", "previous",
    "poutcome", "emp.var.rate", "cons.price.idx", "cons.conf.idx",
    "euribor3m", "nr.employed",
]
DROP_COLS = ["duration", "y", "deposit"]
RENAMES = {
    "dayofweek": "day_of_week",
    "day": "day_of_week",
    "emp_var_rate": "emp.var.rate",
    "empvarrate": "emp.var.rate",
    "cons_price_idx": "cons.price.idx",
    "conspriceidx": "cons.price.idx",
    "cons_conf_idx": "cons.conf.idx",
    "consconfidx": "cons.conf.idx",
    "nr_employed": "nr.employed",
    "nremployed": "nr.employed",
}
COLUMN_DEFAULTS = {
    "day_of_week": "thu",
    "emp.var.rate": 1.1,
    "cons.price.idx": 93.994,
    "cons.conf.idx": -36.4,
    "euribor3m": 4.857,
    "nr.employed": 5191.0,
    "campaign": 2,
    "pdays": 999,
    "previous": 0,
    "poutcome": "nonexistent",
}


def normalise_columns(df: DataFrame, renames: Mapping[str, str] = RENAMES) -> DataFrame:
    """Trim and lower-case every name, then apply the known aliases."""
    names = [c.strip().lower() for c in df.columns]
    names = [renames.get(n, n) for n in names]
    return df.select(*[quoted(old).alias(new) for old, new in zip(df.columns, names)])


def conform_schema(
    df: DataFrame,
    features: Sequence[str] = tuple(FEATURES),
    drop: Sequence[str] = tuple(DROP_COLS),
    defaults: Mapping[str, object] = COLUMN_DEFAULTS,
) -> tuple[DataFrame, list[str], list[str]]:
    """(conformed frame, warnings, still-missing features).

    Normalise names, drop leakage/target columns and extras, fill absent
    features from defaults, and sanitise numerics (NULL/NaN/Inf -> 0, clip +-1e9).
    The NaN/Inf counts for the warnings come from one aggregate.
    """
    out = normalise_columns(df)
    warns: list[str] = []
    dropped = [c for c in drop if c in out.columns]
    if dropped:
        out = out.drop(*dropped)
        warns += [f"Auto-dropped `{c}`" for c in dropped]
    extra = [c for c in out.columns if c not in features]
    if extra:
        out = out.drop(*extra)
        warns.append(f"Dropped extra: {extra}")
    filled = [c for c in features if c not in out.columns and c in defaults]
    if filled:
        out = out.withColumns({c: F.lit(defaults[c]) for c in filled})
        warns.append(f"Auto-filled missing columns with defaults: {filled}")
    nums = [f.name for f in out.schema.fields if isinstance(f.dataType, T.NumericType)]
    if nums:
        counts = out.agg(
            F.sum(sum((F.isnan(quoted(c).cast("double")) | quoted(c).isNull()).cast("int") for c in nums)).alias("nan"),
            F.sum(sum(quoted(c).cast("double").isin(float("inf"), float("-inf")).cast("int") for c in nums)).alias("inf"),
        ).first()
        out = out.withColumns({c: sanitised(c) for c in nums})
        if counts["nan"]:
            warns.append(f"Replaced {counts['nan']} NaN values with 0")
        if counts["inf"]:
            warns.append(f"Replaced {counts['inf']} Inf values with 0")
    still_missing = [c for c in features if c not in out.columns]
    return out, warns, still_missing


def validate_shape(df: DataFrame, rows: int | None = None, cols: int | None = None) -> DataFrame:
    """One row: actual rows/columns and whether they match the expectation."""
    n = df.count()
    ok = (rows is None or n == rows) and (cols is None or len(df.columns) == cols)
    return df.sparkSession.createDataFrame([(n, len(df.columns), bool(ok))], "n_rows long, n_cols int, shape_ok boolean")


def encode_target(df: DataFrame, col: str = "y", positive: str = "yes", negative: str = "no", strict: bool = True) -> DataFrame:
    """yes/no -> 1/0; with ``strict`` any other value raises (one count job)."""
    mapped = F.when(F.col(col) == positive, 1).when(F.col(col) == negative, 0)
    out = df.withColumn(col, mapped)
    if strict:
        bad = df.where(mapped.isNull()).limit(1).count()
        if bad:
            raise ValueError(f"unmapped values in target column {col!r}")
    return out
