"""Secret scans: base patterns, and character Markov models of random strings against ordinary identifiers.

The models are two first-order chains over the characters from ``+`` to ``z``, fitted to labelled tokens; a token whose
log-likelihood ratio speaks for the random chain is reported besides the base matches.  All of it is DataFrame functions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns (name, pattern, group that must be long enough, its least length), in the order of reports.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: A run this long holds no shorter match of its pattern that could pass, so scanning for it directly is the same as scanning and dropping.
DIRECT = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
#: Tokens the models learn from and judge, and their least length.
LEAST = 12
LEARN = JUDGE = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST
LOW, SIZE = ord("+"), ord("z") - ord("+") + 1


#: Characters of base matches, and the private ones that stand for them where a match covers them.
PLAIN = "".join(map(chr, range(0x20, 0x7B)))
COVERED = "".join(chr(0xE000 + ord(c)) for c in PLAIN)
PRIVATE, OTHER = "".join(map(chr, range(0xE000, 0xE080))), "\uf8ff" * 0x80
#: The patterns over text in which some characters are covered: each class has its covered characters, too.
EITHER = {
    "access": "[A\ue041][K\ue04b][I\ue049][A\ue041][A-Z0-9\ue041-\ue05a\ue030-\ue039]{14,}",
    "hex": "[0-9a-f\ue030-\ue039\ue061-\ue066]{16,}",
    "judge": "[A-Za-z0-9+/_=\ue041-\ue05a\ue061-\ue07a\ue030-\ue039\ue02b\ue02f\ue05f\ue03d\ue02d-]{%d,}" % LEAST,
}
#: Doublings of the running sums, enough for the matches (12 characters and more) of the longest text that a row can hold.
DOUBLINGS = 28


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def running(values: Column) -> Column:
    """Running sums of an array, by doubling: n log n steps, none of which copies what is done so far for each element."""
    out = values
    for k in range(DOUBLINGS):

        def add(a, step=1 << k):
            before = F.concat(F.array_repeat(F.lit(0), F.least(F.size(a), F.lit(step))), F.slice(a, 1, F.size(a) - step))
            return F.when(F.size(a) > step, F.zip_with(a, before, lambda x, y: x + y)).otherwise(a)

        out = once(out, add)
    return out


def may_hold(text: Column, kind: str) -> Column:
    """Whether the text can hold a match of a base pattern, by plain search where a match must have some string."""
    if kind == "assign":
        low = F.lower(text)
        return reduce(lambda a, b: a | b, [low.contains(w) for w in ("password", "passwd", "secret", "token", "apikey", "api_key")])
    return text.contains("AKIA") if kind == "access" else text.rlike(DIRECT[kind])


def match_spans(text: Column, pattern: str, group: int, least: int, kind: str, order: int, guard: Column | None = None, words: bool = False) -> Column:
    """Array of (start, ord, end, kind) of the leftmost non-overlapping matches whose ``group`` has ``least`` characters, with their
    text if ``words``.  Rows where ``guard`` is false are known to have none.

    The pieces between matches and the matches themselves give the positions, in code points.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    fields = "start:int,ord:int,end:int,kind:string" + (",word:string" if words else "")

    def placed(w):
        ends = running(F.zip_with(F.slice(gaps, 1, F.size(w)), w, lambda g, x: g + F.length(x)))
        seen = F.arrays_zip(ends.alias("end"), w.alias("w"), (F.transform(part, F.length) if group else F.transform(w, F.length)).alias("m"))
        fine = F.filter(seen, lambda x: x["m"] >= least)
        word = [lambda x: x["w"].alias("word")] if words else []
        return F.transform(
            fine,
            lambda x: F.struct(
                (x["end"] - F.length(x["w"])).alias("start"), F.lit(order).alias("ord"), x["end"].alias("end"), F.lit(kind).alias("kind"), *[f(x) for f in word]
            ),
        )

    found = once(whole, placed)
    return (found if guard is None else F.when(guard, found).otherwise(F.array())).cast(f"array<struct<{fields}>>")


def covered(text: Column, pattern: str, group: int, least: int, guard: Column) -> Column:
    """``text`` with the characters of accepted matches replaced by those that stand for them; the length stays."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    hidden = F.transform(F.arrays_zip(whole.alias("w"), part.alias("p")), lambda x: F.when(F.length(x["p"]) >= least, F.translate(x["w"], PLAIN, COVERED)).otherwise(x["w"]))
    joined = F.array_join(F.zip_with(F.split(text, pattern, -1), hidden, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(guard, joined).otherwise(text)


def labelled_tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, random) of the whole corpus: values that base patterns accept are random strings, other tokens of 12 and
    more characters are ordinary."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    secret = []
    for kind, pattern, group, least in BASE:
        p = DIRECT.get(kind, pattern)
        found = F.when(may_hold(text, kind), F.regexp_extract_all(text, F.lit(p), F.lit(group)))
        secret.append(F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda t, n=least: F.length(t) >= n))
    other = F.filter(
        F.regexp_extract_all(text, F.lit(LEARN), F.lit(0)), lambda t: ~t.rlike("|".join([DIRECT["access"], DIRECT["hex"], "(?i:password|passwd|secret|token|api_?key)"]))
    )
    both = docs.select(F.concat(*secret).alias("s"), other.alias("o")).select(F.explode(F.array(F.struct(F.lit(True).alias("random"), F.col("s").alias("t")), F.struct(F.lit(False).alias("random"), F.col("o").alias("t")))).alias("x"))
    rows = both.select("x.random", F.explode("x.t").alias("token"))
    return rows


def fit_models(samples: DataFrame, smooth: float = 0.5) -> list[float]:
    """Log-likelihood ratios of each pair of successive characters, SIZE x SIZE, from (token, random) rows.

    Pairs outside the alphabet and null tokens are left out; without samples all ratios are 0.  What reaches the driver is at
    most two counts for each pair.
    """
    pairs = samples.filter(F.length("token") > 1).select("random", F.explode(F.expr(
        f"transform(sequence(1, length(token) - 1), i -> named_struct('a', ascii(substring(token, i, 1)) - {LOW}, 'b', ascii(substring(token, i + 1, 1)) - {LOW}))")).alias("p"))
    counts = pairs.groupBy("random", "p.a", "p.b").agg(F.count("*").alias("n")).filter(f"a between 0 and {SIZE - 1} and b between 0 and {SIZE - 1}").collect()
    tables = {True: [smooth] * (SIZE * SIZE), False: [smooth] * (SIZE * SIZE)}
    for r in counts:
        if r["random"] is not None:
            tables[r["random"]][r["a"] * SIZE + r["b"]] += r["n"]
    ratios = []
    for a in range(SIZE):
        row = {k: t[a * SIZE : (a + 1) * SIZE] for k, t in tables.items()}
        total = {k: sum(x) for k, x in row.items()}
        ratios += [round(math.log(x / total[True]) - math.log(y / total[False]), 3) for x, y in zip(row[True], row[False])]
    return ratios


def likelihood_ratio(token: Column, ratios: list[float]) -> Column:
    """Sum of the ratios over the pairs of a token."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")  # folded to one literal
    at = lambda i: F.ascii(F.substring(token, i, F.lit(1))) - LOW
    return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), lambda s, i: s + F.get(table, at(i) * SIZE + at(i + 1)))


def scan(docs: DataFrame, ratios: list[float], least: float = 6.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, assign, access, hex, markov (arrays of start, ord, end, kind; code points, end exclusive).

    ``markov`` has the tokens of 12 and more characters whose ratio is at least ``least`` (about 1000 to 1) and that base spans don't cover wholly.
    Null and empty texts have no spans; ids may be null or repeated, each row is reported; an empty table gives no row;
    other columns are ignored.
    """
    limit = float(least)
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    out = out.select("*", *[may_hold(F.col("_text"), kind).alias(f"_may_{kind}") for kind, *_ in BASE])
    spans = {k: match_spans(F.col("_text"), DIRECT.get(k, p), g, n, k, i, F.col(f"_may_{k}")) for i, (k, p, g, n) in enumerate(BASE)}
    # what base matches cover is marked in the text itself, so that a token shows whether it is covered wholly
    free = F.when(F.col("_text").rlike(f"[{PRIVATE[0]}-{PRIVATE[-1]}]"), F.translate("_text", PRIVATE, OTHER)).otherwise(F.col("_text"))
    out = out.select("doc_id", *[c.alias(k) for k, c in spans.items()], *[f"_may_{k}" for k in spans], free.alias("_marked"))
    for kind, pattern, group, size in BASE:
        out = out.withColumn("_marked", covered(F.col("_marked"), EITHER.get(kind, pattern), group, size, F.col(f"_may_{kind}") & (F.size(kind) > 0)))
    out = out.withColumn("_tokens", match_spans(F.col("_marked"), EITHER["judge"], 0, LEAST, "markov", len(BASE), words=True))
    plain = lambda t: t["word"].rlike(f"[^{PRIVATE[0]}-{PRIVATE[-1]}]")
    markov = F.filter("_tokens", lambda t: plain(t) & (likelihood_ratio(F.translate(t["word"], COVERED, PLAIN), ratios) >= limit))
    bare = F.transform(markov, lambda t: F.struct(t["start"].alias("start"), t["ord"].alias("ord"), t["end"].alias("end"), t["kind"].alias("kind")))
    return out.select("doc_id", "assign", "access", "hex", bare.alias("markov"))
