"""URL filter: host-suffix and path-prefix expressions, looked up by short hash prefixes.

Every URL is expanded into the expressions (a suffix of its host's labels, a prefix of its path) that a rule could
have; they meet the rules in an equi-join on the first 32 bits of SHA-256, the full digest is confirmed, and the
longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import free_name

#: Rules up to this many are broadcast (some 150 bytes each); more are joined with a shuffle over SALTS copies of each.
MOST_BROADCAST = 100_000
SALTS = 16


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """``urls`` with columns host, path, rule (host and path of the rule that decides, else null) and verdict.

    ``rules`` has columns host, path, verdict (allow or block).  A rule fits its host and all subdomains if the URL's path
    starts with the rule's; the longest (host and path together, then the host) wins; of equal rules, block.  Without
    a fitting rule the verdict is ``default``.  Rules with a null in any of the three are ignored; null URLs, URLs without
    ``://`` and empty tables are judged like any other (empty host and path).  Repeated rows are judged each.
    Columns of ``urls`` called host, path, rule or verdict are replaced.
    """
    known = rules.select(F.lower("host").alias("host"), "path", "verdict").dropna()
    known = known.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
    shape = known.agg(
        F.count("*").alias("n"),
        F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths"),
    ).first()
    rest = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    text = F.col(url_col)
    base = urls.select(*rest, host_of(text).alias("host"), path_of(text).alias("path"))
    if not shape["n"]:
        return base.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    hosts = [F.substring_index("host", ".", -k) for k in sorted(shape["labels"])]
    paths = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(shape["lengths"])]
    pairs = F.array_distinct(F.array(*[F.when(p.isNotNull(), F.struct(h.alias("h"), p.alias("p"))) for h in hosts for p in paths]))

    def digest(h, p):
        return F.sha2(F.concat_ws("\n", h, p), 256)

    distinct = base.select("host", "path").distinct()  # a hot URL is one row from here on
    exprs = distinct.select("host", "path", F.explode(F.array_compact(pairs)).alias("e")).withColumn("full", digest("e.h", "e.p"))
    exprs = exprs.select("host", "path", F.substring("full", 1, 8).alias("short"), "full")
    rank = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("own"), F.concat("host", "path").alias("rule"), "verdict")
    table = known.withColumn("full_r", digest("host", "path")).select(F.substring("full_r", 1, 8).alias("short"), "full_r", rank.alias("r"))
    if shape["n"] <= MOST_BROADCAST:
        met = exprs.join(F.broadcast(table), "short")
    else:
        salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = exprs.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")).join(salted, ["short", "salt"])
    r = free_name(base, "r")
    best = met.filter("full = full_r").groupBy("host", "path").agg(F.max("r").alias(r))
    return base.join(best, ["host", "path"], "left").select(*rest, "host", "path", F.col(r)["rule"].alias("rule"), F.coalesce(F.col(r)["verdict"], F.lit(default)).alias("verdict"))
