"""Campaign-shaped views over the driver tables.

The reference works on one bank-marketing table; the driver tables are a
TPC-H-like star schema.  These views give the operators the roles they need
(a binary target, categories, numerics, a sentinel, dirty values, scores)
and each has a SQL twin (``*_SQL``) used by the DuckDB oracle.  Both sides
use only exact integer / IEEE arithmetic so results agree bit for bit.

* ``leads``      (lineitem, the largest table): target ``y = returnflag 'R'``,
                  categories, numerics and a stand-in model ``score``.
* ``prospects``  (orders): deterministic dirt for the cleaning operators:
                  ``unknown`` levels, NaN and NULL numerics, the 999 sentinel.
* ``model_scores`` (lineitem): four stand-in models x two stages, long form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# leads (lineitem)
# ---------------------------------------------------------------------------
def _noise_sql(a: int, b: int, c: int, d: int, e: int, mod: int) -> str:
    return (
        f"((CAST(l_quantity AS INTEGER) * {a} + CAST(round(l_discount * 100) AS INTEGER) * {b}"
        f" + l_linenumber * {c} + day(l_shipdate) * {d} + CAST(l_orderkey % 97 AS INTEGER) * {e}) % {mod})"
    )


# Stand-in scorers: (a, b, c, d, e, modulus, label shift); score = k / 1000.
SCORERS = {
    "logistic_regression": (7, 13, 29, 3, 11, 700, 300),
    "random_forest": (11, 5, 17, 7, 3, 650, 350),
    "xgboost": (3, 17, 13, 11, 5, 600, 400),
    "knn": (13, 7, 3, 5, 17, 800, 200),
}
# Weaker "before tuning" variants: the label shift is halved.
BASELINE_SHIFT = {m: s[6] // 2 for m, s in SCORERS.items()}


def _score_sql(model: str, shift: int | None = None) -> str:
    a, b, c, d, e, mod, sh = SCORERS[model]
    s = sh if shift is None else shift
    return f"CAST({_noise_sql(a, b, c, d, e, mod)} + (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * {s} AS DOUBLE) / 1000.0"


def _noise_spark(a: int, b: int, c: int, d: int, e: int, mod: int) -> str:
    return (
        f"((CAST(l_quantity AS INT) * {a} + CAST(round(l_discount * 100) AS INT) * {b}"
        f" + l_linenumber * {c} + dayofmonth(l_shipdate) * {d} + CAST(l_orderkey % 97 AS INT) * {e}) % {mod})"
    )


def _score_spark(model: str, shift: int | None = None) -> str:
    a, b, c, d, e, mod, sh = SCORERS[model]
    s = sh if shift is None else shift
    return f"CAST({_noise_spark(a, b, c, d, e, mod)} + (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * {s} AS DOUBLE) / 1000.0D"


# Spark SQL projections (one analyzer round trip per view instead of one per Column node).
LEADS_EXPRS = [
    "l_orderkey * 10 + l_linenumber AS lead_id",
    "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y",
    "l_linestatus AS status",
    "lower(date_format(l_shipdate, 'MMM')) AS month",
    "lower(date_format(l_shipdate, 'EEE')) AS day_of_week",
    "l_linenumber AS linenumber",
    "l_quantity AS quantity",
    "l_extendedprice AS price",
    "l_discount AS discount",
    "l_tax AS tax",
    "l_extendedprice * (1.0D - l_discount) AS net_price",
    f"{_score_spark('logistic_regression')} AS score",
]


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*LEADS_EXPRS)


LEADS_SQL = f"""
SELECT l_orderkey * 10 + l_linenumber AS lead_id,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
       l_linestatus AS status,
       lower(strftime(l_shipdate, '%b')) AS month,
       lower(strftime(l_shipdate, '%a')) AS day_of_week,
       l_linenumber AS linenumber,
       l_quantity AS quantity,
       l_extendedprice AS price,
       l_discount AS discount,
       l_tax AS tax,
       l_extendedprice * (1.0 - l_discount) AS net_price,
       {_score_sql("logistic_regression")} AS score
FROM lineitem
"""


# Per-row integer features shared by all stand-in scorers (computed once, before the stack).
_BASE_EXPRS = [
    "l_orderkey * 10 + l_linenumber AS lead_id",
    "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y",
    "CAST(l_quantity AS INT) AS _q",
    "CAST(round(l_discount * 100) AS INT) AS _d",
    "l_linenumber AS _l",
    "dayofmonth(l_shipdate) AS _dd",
    "CAST(l_orderkey % 97 AS INT) AS _o",
]


def _score_from_base(model: str, shift: int | None = None) -> str:
    a, b, c, d, e, mod, sh = SCORERS[model]
    s = sh if shift is None else shift
    return f"CAST((_q * {a} + _d * {b} + _l * {c} + _dd * {d} + _o * {e}) % {mod} + y * {s} AS DOUBLE) / 1000.0D"


def model_scores(spark: SparkSession, sf_dir: str, stages: tuple[str, ...] = ("tuned", "baseline")) -> DataFrame:
    """Long form: (lead_id, y, model, stage, score) for 4 models x the requested stages."""
    entries = []
    for m in SCORERS:
        for st in stages:
            entries += [f"'{m}'", f"'{st}'", _score_from_base(m, BASELINE_SHIFT[m] if st == "baseline" else None)]
    base = table(spark, sf_dir, "lineitem").selectExpr(*_BASE_EXPRS)
    return base.selectExpr("lead_id", "y", f"stack({len(entries) // 3}, {', '.join(entries)}) AS (model, stage, score)")


def _model_scores_sql() -> str:
    parts = []
    for m in SCORERS:
        for stage, shift in (("tuned", None), ("baseline", BASELINE_SHIFT[m])):
            parts.append(
                f"SELECT l_orderkey * 10 + l_linenumber AS lead_id, "
                f"CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, "
                f"'{m}' AS model, '{stage}' AS stage, {_score_sql(m, shift)} AS score FROM lineitem"
            )
    return "\nUNION ALL\n".join(parts)


MODEL_SCORES_SQL = _model_scores_sql()


# ---------------------------------------------------------------------------
# prospects (orders) with deterministic dirt
# ---------------------------------------------------------------------------
PROSPECTS_EXPRS = [
    "o_orderkey AS prospect_id",
    "o_custkey AS cust_id",
    "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y",
    "CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE o_orderpriority END AS priority",
    "CASE WHEN o_orderkey % 11 = 0 THEN 'unknown' ELSE lower(date_format(o_orderdate, 'MMM')) END AS month",
    "lower(date_format(o_orderdate, 'EEE')) AS day_of_week",
    "CASE WHEN o_orderkey % 29 = 0 THEN 'unknown' ELSE o_orderstatus END AS status_code",
    "CASE WHEN o_orderkey % 19 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 23 = 0 THEN CAST(NULL AS DOUBLE) "
    "ELSE o_totalprice END AS amount",
    "CASE WHEN o_orderkey % 7 <> 0 THEN 999 ELSE CAST(o_custkey % 30 AS INT) END AS pdays",
    "CAST(o_custkey % 10 AS INT) AS previous",
    "year(o_orderdate) AS year",
]


def prospects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*PROSPECTS_EXPRS)


PROSPECTS_SQL = """
SELECT o_orderkey AS prospect_id,
       o_custkey AS cust_id,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
       CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE o_orderpriority END AS priority,
       CASE WHEN o_orderkey % 11 = 0 THEN 'unknown' ELSE lower(strftime(o_orderdate, '%b')) END AS month,
       lower(strftime(o_orderdate, '%a')) AS day_of_week,
       CASE WHEN o_orderkey % 29 = 0 THEN 'unknown' ELSE o_orderstatus END AS status_code,
       CASE WHEN o_orderkey % 19 = 0 THEN CAST('NaN' AS DOUBLE)
            WHEN o_orderkey % 23 = 0 THEN CAST(NULL AS DOUBLE)
            ELSE o_totalprice END AS amount,
       CASE WHEN o_orderkey % 7 <> 0 THEN 999 ELSE CAST(o_custkey % 30 AS INTEGER) END AS pdays,
       CAST(o_custkey % 10 AS INTEGER) AS previous,
       CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders
"""


# ---------------------------------------------------------------------------
# bank-shaped customers (orders): the reference's column names and roles
# ---------------------------------------------------------------------------
# The levels of the public bank-marketing categories.
JOB_LEVELS = [
    "admin.", "blue-collar", "entrepreneur", "housemaid", "management", "retired",
    "self-employed", "services", "student", "technician", "unemployed", "unknown",
]
MARITAL_LEVELS = ["divorced", "married", "single", "unknown"]
HOUSING_LEVELS = ["no", "yes", "unknown"]


def _pick_spark(levels: list[str], idx: str) -> str:
    return "element_at(array(" + ", ".join(f"'{v}'" for v in levels) + f"), CAST({idx} AS INT) + 1)"


def _pick_sql(levels: list[str], idx: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in levels) + f"][CAST({idx} AS INTEGER) + 1]"


def _bank_exprs() -> list[str]:
    from leadlens.operators.features import EDUCATION_ORDER

    return [
        "o_orderkey AS client_id",
        "CAST(18 + o_custkey % 72 AS INT) AS age",
        f"{_pick_spark(JOB_LEVELS, 'o_custkey % 12')} AS job",
        f"{_pick_spark(MARITAL_LEVELS, 'o_orderkey % 4')} AS marital",
        f"{_pick_spark(EDUCATION_ORDER, 'o_custkey % 8')} AS education",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE 'no' END AS `default`",
        f"{_pick_spark(HOUSING_LEVELS, 'o_orderkey % 3')} AS housing",
        "CASE WHEN o_orderkey % 7 < 2 THEN 'yes' WHEN o_orderkey % 7 = 2 THEN 'unknown' ELSE 'no' END AS loan",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'telephone' ELSE 'cellular' END AS contact",
        "lower(date_format(o_orderdate, 'MMM')) AS month",
        "lower(date_format(o_orderdate, 'EEE')) AS day_of_week",
        "CAST(10 + o_orderkey % 990 AS INT) AS duration",
        "CAST(1 + o_orderkey % 14 AS INT) AS campaign",
        "CASE WHEN o_orderkey % 7 <> 0 THEN 999 ELSE CAST(o_custkey % 28 AS INT) END AS pdays",
        "CASE WHEN o_orderkey % 7 <> 0 THEN 0 ELSE CAST(o_custkey % 5 AS INT) END AS previous",
        "CASE WHEN o_orderkey % 7 <> 0 THEN 'nonexistent' WHEN o_custkey % 2 = 0 THEN 'failure' ELSE 'success' END AS poutcome",
        "CAST(o_orderkey % 51 AS DOUBLE) / 10.0D - 3.4D AS `emp.var.rate`",
        "92.0D + CAST(o_custkey % 3000 AS DOUBLE) / 1000.0D AS `cons.price.idx`",
        "-50.0D + CAST(o_orderkey % 251 AS DOUBLE) / 10.0D AS `cons.conf.idx`",
        "0.5D + CAST(o_custkey % 4500 AS DOUBLE) / 1000.0D AS euribor3m",
        "4960.0D + CAST(o_orderkey % 2701 AS DOUBLE) / 10.0D AS `nr.employed`",
        "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y",
    ]


def bank_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_bank_exprs())


def _bank_sql() -> str:
    from leadlens.operators.features import EDUCATION_ORDER

    return f"""
SELECT o_orderkey AS client_id,
       CAST(18 + o_custkey % 72 AS INTEGER) AS age,
       {_pick_sql(JOB_LEVELS, 'o_custkey % 12')} AS job,
       {_pick_sql(MARITAL_LEVELS, 'o_orderkey % 4')} AS marital,
       {_pick_sql(EDUCATION_ORDER, 'o_custkey % 8')} AS education,
       CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE 'no' END AS "default",
       {_pick_sql(HOUSING_LEVELS, 'o_orderkey % 3')} AS housing,
       CASE WHEN o_orderkey % 7 < 2 THEN 'yes' WHEN o_orderkey % 7 = 2 THEN 'unknown' ELSE 'no' END AS loan,
       CASE WHEN o_orderkey % 3 = 0 THEN 'telephone' ELSE 'cellular' END AS contact,
       lower(strftime(o_orderdate, '%b')) AS month,
       lower(strftime(o_orderdate, '%a')) AS day_of_week,
       CAST(10 + o_orderkey % 990 AS INTEGER) AS duration,
       CAST(1 + o_orderkey % 14 AS INTEGER) AS campaign,
       CASE WHEN o_orderkey % 7 <> 0 THEN 999 ELSE CAST(o_custkey % 28 AS INTEGER) END AS pdays,
       CASE WHEN o_orderkey % 7 <> 0 THEN 0 ELSE CAST(o_custkey % 5 AS INTEGER) END AS previous,
       CASE WHEN o_orderkey % 7 <> 0 THEN 'nonexistent' WHEN o_custkey % 2 = 0 THEN 'failure' ELSE 'success' END AS poutcome,
       CAST(o_orderkey % 51 AS DOUBLE) / 10.0 - CAST('3.4' AS DOUBLE) AS "emp.var.rate",
       CAST('92.0' AS DOUBLE) + CAST(o_custkey % 3000 AS DOUBLE) / 1000.0 AS "cons.price.idx",
       CAST('-50.0' AS DOUBLE) + CAST(o_orderkey % 251 AS DOUBLE) / 10.0 AS "cons.conf.idx",
       CAST('0.5' AS DOUBLE) + CAST(o_custkey % 4500 AS DOUBLE) / 1000.0 AS euribor3m,
       CAST('4960.0' AS DOUBLE) + CAST(o_orderkey % 2701 AS DOUBLE) / 10.0 AS "nr.employed",
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y
FROM orders
"""


BANK_SQL = _bank_sql()
