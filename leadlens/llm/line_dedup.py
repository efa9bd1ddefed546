"""Line de-duplication by an exact set-similarity join, with DataFrame functions only.

A line is the set of its five-word shingles (a shorter line: its words as one shingle).  Shingles are ordered by rarity: that of
their rarest word over all texts, and their own among lines of large groups.  Two sets of Jaccard similarity s or more share one of the first n - ceil(s n) + 1, which is what the join is on.  Length and
positional filters follow, the similarity is verified, and a line is removed if an earlier one matches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.llm.common import free_name, text_of, written

#: Word counts are kept for so many groups of words (by hash); 8 bytes each reach the driver, one number each the tasks.
GROUPS = 1 << 16
#: Up to so many documents and lines to verify, their ids and numbers are broadcast (some 50 and 4 bytes each); beyond it they are joined by a shuffle.
MOST_BROADCAST, MOST_NUMBERS = 300_000, 2_000_000
SHIFT = 57


def words_of(line: Column) -> Column:
    """Lower-case words, separated by ASCII white space.  Lines with single blanks alone are split without a pattern."""
    odd = (line == "") | line.startswith(" ") | line.endswith(" ")
    for white in ("  ", "\t", "\r", "\f", "\x0b"):
        odd = odd | line.contains(white)
    return F.when(odd, F.array_remove(F.split(F.lower(line), r"[\s\x0B]+"), "")).otherwise(F.split(F.lower(line), " "))


def _exploded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, h, no, line): id, hash of the text, number from 0, line."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("h"), F.posexplode(F.split(text, "\n")).alias("no", "line"))


def word_ranks(docs: DataFrame, text_col: str = "text") -> list[int]:
    """A rank from 0 (rare) to 63 of each group of words, by the logarithm of its count over all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.replace(text_of(text_col), F.lit("\n"), F.lit(" "))), " ")).alias("w"))
    counts = words.groupBy(F.xxhash64("w").bitwiseAND(F.lit(GROUPS - 1)).alias("g")).agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in counts) or 1
    ranks = [0] * GROUPS
    for r in counts:
        ranks[r["g"]] = max(0, min(63, int(3 * math.log2(r["n"] * GROUPS / total)) + 8))
    return ranks


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def line_tokens(hashes: Column, ranks: list[int], shingle: int = 5) -> Column:
    """Distinct shingles, from the hashes of the words, as sorted longs, rarest first: the rank of the rarest word, which bounds how common
    a shingle can be, above 57 bits of its hash.  The shingle is folded from the left, two words at a time."""
    table = F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<bigint>")  # folded to one literal
    low = lambda h: F.shiftrightunsigned(h, 64 - SHIFT)
    ranked = F.transform(hashes, lambda x: F.shiftleft(F.get(table, x.bitwiseAND(F.lit(GROUPS - 1)).cast("int")), SHIFT).bitwiseOR(low(x)))
    fold = lambda a, b: F.least(a, b).bitwiseXOR(low(F.xxhash64(a, b)))  # noqa: E731  # the rank above stays, the bits below stay a hash
    out, width = ranked, 1
    while width < shingle:  # the last fold may overlap
        step = min(width, shingle - width)
        out = once(out, lambda o, step=step: F.zip_with(o, F.slice(o, step + 1, F.size(o)), fold))
        width += step
    return F.when(F.size(hashes) < shingle, F.array(low(F.xxhash64(hashes)))).otherwise(F.sort_array(F.array_distinct(F.slice(out, 1, F.size(hashes) - (shingle - 1)))))


def _line_sets(docs: DataFrame, places: DataFrame, ranks: list[int], shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(p, t): the shingles of the lines at the places p."""
    wanted = places.groupBy(F.col("p.d").alias("wd"), F.col("p.h").alias("wh")).agg(F.collect_set("p.no").alias("nos"))
    wanted = written(wanted, "lines_to_verify")
    size = wanted.agg(F.count("*").alias("documents"), F.coalesce(F.sum(F.size("nos")), F.lit(0)).alias("numbers")).first()
    if size["documents"] <= MOST_BROADCAST and size["numbers"] <= MOST_NUMBERS:
        wanted = F.broadcast(wanted)
    rows = docs.select(F.col(id_col).alias("d"), text_of(text_col).alias("t")).withColumn("h", F.xxhash64("t"))
    rows = rows.join(wanted, F.col("d").eqNullSafe(F.col("wd")) & (F.col("h") == F.col("wh")))
    lines = rows.withColumn("lines", F.split("t", "\n")).select("d", "h", F.explode("nos").alias("no"), "lines")
    lines = lines.select(F.struct("d", "h", "no").alias("p"), F.get("lines", F.col("no")).alias("line")).dropDuplicates(["p"])
    return written(lines.select("p", line_tokens(F.transform(words_of(F.col("line")), lambda w: F.xxhash64(w)), ranks, shingle).alias("t")), "line_sets")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of candidate pairs (x, y; places of lines) the places x whose lines reach the similarity."""
    met = pairs.join(sets.select(F.col("p").alias("x"), F.col("t").alias("tx")), "x").join(sets.select(F.col("p").alias("y"), F.col("t").alias("ty")), "y")
    both = F.size(F.array_intersect("tx", "ty"))
    return met.filter(both >= F.lit(similarity) * (F.size("tx") + F.size("ty") - both)).select("x").distinct()


def distinct_lines(docs: DataFrame, ranks: list[int], similarity: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct line with words: k (hash), place (d, h, no) of its first occurrence, n (shingles), prefix."""
    lines = _exploded(docs, id_col, text_col).filter(F.col("line").rlike(r"[^\s\x0B]"))
    lines = lines.select("d", "h", "no", F.transform(words_of(F.col("line")), lambda w: F.xxhash64(w)).alias("x"))
    lines = lines.select("d", "h", "no", F.struct(F.xxhash64("x").alias("a"), F.xxhash64(F.lit(1), "x").alias("b")).alias("k"), line_tokens(F.col("x"), ranks, shingle).alias("t"))
    n = F.size("t")
    lines = lines.select("k", F.struct("d", "h", "no").alias("place"), n.alias("n"), F.slice("t", 1, n - F.ceil(n * F.lit(similarity)).cast("int") + 1).alias("prefix"))
    return lines.groupBy("k").agg(F.min("place").alias("place"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))


def matched_lines(docs: DataFrame, distinct: DataFrame, ranks: list[int], similarity: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Places x of the distinct lines that an earlier line matches.

    Lines that share a prefix shingle are first compared with the earliest of them only.  The lines of shingles that three or more
    share then meet in a second prefix join of their own, in which shingles are ordered by their true counts among these lines: what
    a large group has in common comes last, so that only lines that share their rare shingles too are compared.
    """
    s = F.lit(similarity)
    rows = distinct.select(F.col("k.a").alias("a"), F.posexplode("prefix").alias("i", "token"))
    same = Window.partitionBy("token")
    rows = rows.withColumn("many", F.count("*").over(same)).filter("many > 1").drop("many").join(distinct.select(F.col("k.a").alias("a"), "place", "n"), "a")
    rows = rows.select("token", "place", "n", "i", F.count("*").over(same).alias("many"), F.min(F.struct("place", "n", "i")).over(same).alias("head"))
    rows = written(rows, "prefix_rows")

    def alike(n, m, i, j) -> Column:
        """Length filter, and the positional filter on the first shared shingle."""
        need = F.ceil(s / (1 + s) * (n + m) - F.lit(1e-9))
        return (n >= s * m - F.lit(1e-9)) & (m >= s * n - F.lit(1e-9)) & (1 + F.least(n - i - 1, m - j - 1) >= need)

    c = F.col
    first = rows.filter((c("head.place") != c("place")) & alike(c("n"), c("head.n"), c("i"), c("head.i"))).select(c("place").alias("x"), c("head.place").alias("y")).distinct()
    first = written(first, "line_pairs")
    ends = first.select(F.col("x").alias("p")).unionByName(first.select(F.col("y").alias("p"))).distinct()
    got = written(_verified(first, _line_sets(docs, ends, ranks, shingle, id_col, text_col), similarity), "matched_lines")
    members = rows.filter("many > 2 and head.place <> place").select(F.col("place").alias("p")).distinct()
    sets = _line_sets(docs, members, ranks, shingle, id_col, text_col)
    tokens = sets.select("p", F.size("t").alias("n"), F.explode("t").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("count")).filter("count > 1")
    ordered = tokens.join(shared, "token").groupBy("p").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("count", "token"))).alias("o"))
    # shingles of one line alone come before all others and meet nothing
    alone, length = F.col("n") - F.size("o"), F.col("n") - F.ceil(F.col("n") * s).cast("int") + 1
    prefix = ordered.select("p", "n", alone.alias("alone"), F.posexplode(F.slice("o", 1, F.greatest(length - alone, F.lit(0)))).alias("at", "t"))
    prefix = written(prefix.select("p", "n", (F.col("alone") + F.col("at")).alias("i"), F.col("t.token").alias("token")), "second_prefixes")
    left = prefix.select(c("p").alias("x"), c("n").alias("xn"), c("i").alias("xi"), "token").join(got, "x", "left_anti")
    right = prefix.select(c("p").alias("y"), c("n").alias("yn"), c("i").alias("yi"), "token")
    more = left.join(right, "token").filter(c("y") < c("x")).filter(alike(c("xn"), c("yn"), c("xi"), c("yi"))).select("x", "y").distinct()
    return got.unionByName(_verified(written(more, "line_pairs"), sets, similarity))


def dedup_lines(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines removed from the text that match an earlier line (by id, text hash, number of the line; nulls
    first) in any document; lines without words stay.  Two columns more: n_lines, n_removed (columns of these names are replaced).

    A document whose lines all go keeps its row with the lines without words, if any.  A null text stays null and counts as no
    line with words; rows with equal id and text are one document, and all of them keep its lines; an empty table gives no row.
    Lines are parts between line feeds; case and the amount of white space don't matter to a match.
    """
    ranks = word_ranks(docs, text_col)
    distinct = written(distinct_lines(docs, ranks, similarity, shingle, id_col, text_col), "distinct_lines")
    gone = matched_lines(docs, distinct, ranks, similarity, shingle, id_col, text_col)
    stay = distinct.join(gone, F.col("place") == F.col("x"), "left_anti").select("place.*").groupBy("d", "h").agg(F.collect_list("no").alias("nos"))
    h, d2, h2, nos, lines = (free_name(docs, x) for x in ("_h", "_dd", "_hh", "_nos", "_lines"))
    stay = stay.select(F.col("d").alias(d2), F.col("h").alias(h2), F.col("nos").alias(nos))
    keyed = docs.withColumn(h, F.xxhash64(text_of(text_col)))
    met = keyed.join(stay, F.col(id_col).eqNullSafe(F.col(d2)) & (F.col(h) == F.col(h2)), "left").withColumn(lines, F.split(F.col(text_col), "\n"))
    blank = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(F.col(lines), i).rlike(r"^[\s\x0B]*$"))
    kept = F.sort_array(F.array_union(F.coalesce(nos, F.array().cast("array<int>")), blank))
    new = F.when(F.col(text_col).isNotNull(), F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n"))
    out = met.withColumn("n_lines", F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long"))
    out = out.withColumn("n_removed", F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines) - F.size(kept)).cast("long"))
    return out.withColumn(text_col, new).select(*[c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")], "n_lines", "n_removed")
