"""Compare a registered Spark query with its DuckDB SQL twin (like the driver does).

Usage: python -m tests.oracle_util [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        if not isinstance(v, (list, tuple)) and not hasattr(v, "__len__") and pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if math.isinf(v):
            return str(v)
        return float(f"{v:.9g}") + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    try:
        import numpy as np

        if isinstance(v, np.ndarray):
            return tuple(_norm(x) for x in v.tolist())
    except Exception:
        pass
    if isinstance(v, pd.Timestamp):
        return str(v)
    return v


def _close(x: tuple, y: tuple) -> bool:
    """Row equality with a float tolerance (engines sum in different orders)."""
    if len(x) != len(y):
        return False
    for u, v in zip(x, y):
        if isinstance(u, float) and isinstance(v, float):
            if not math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-9):
                return False
        elif u != v:
            return False
    return True


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, f"{x:.6g}" if isinstance(x, float) else str(x)) for x in r))


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    from leadlens.plans.registry import ORACLE, QUERIES

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if name not in ORACLE:
        res["oracle"] = "none"
        return res
    opdf = con.execute(ORACLE[name]).df()
    res["oracle_rows"] = len(opdf)
    res["cols_match"] = sorted(spdf.columns) == sorted(opdf.columns)
    if not res["cols_match"]:
        res["spark_cols"] = sorted(spdf.columns)
        res["oracle_cols"] = sorted(opdf.columns)
        res["match"] = False
        return res
    a, b = _rows(spdf), _rows(opdf)
    res["match"] = len(a) == len(b) and all(_close(x, y) for x, y in zip(a, b))
    if not res["match"]:
        diff = [(x, y) for x, y in zip(a, b) if not _close(x, y)][:3]
        res["first_diff"] = diff
    # type check (spark type vs duckdb type family)
    sty = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dty = {c: str(t) for c, t in zip(opdf.columns, con.execute(ORACLE[name]).description and [d[1] for d in con.execute(ORACLE[name]).description])}
    res["types"] = {c: (sty[c], dty.get(c)) for c in sty}
    return res


TYPE_FAMILY = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "float": "FLOAT",
}


def type_mismatches(res: dict) -> dict:
    out = {}
    for c, (s, d) in res.get("types", {}).items():
        want = TYPE_FAMILY.get(s)
        if want and d and want not in d.upper():
            out[c] = (s, d)
    return out


if __name__ == "__main__":
    from leadlens.plans import catalog  # noqa: F401  (registers queries)
    from leadlens.plans.registry import QUERIES
    from leadlens.session import local_session

    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf, args = args[0], args[1:]
    spark = local_session(8)
    con = duck(sf)
    names = args or sorted(QUERIES)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf, n, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:400]}
        tm = type_mismatches(r)
        ok = r.get("match", r.get("oracle") == "none") and not tm and "error" not in r
        bad += not ok
        r.pop("types", None)
        print(("OK   " if ok else "FAIL ") + str(r) + (f" TYPES {tm}" if tm else ""), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
