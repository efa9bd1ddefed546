"""Spelling variants: words at edit distance one, found by dynamic programming down sorted word lists.

Blocks: of two words at distance one, m the length of the shorter and i their first difference, one lies left of the
other half, so that they share their first m // 2 characters (i at or after them) or all from there on (i before).  A block
(m, lo, hi) holds the words of m and m + 1 characters that share what lies outside the free range [lo, hi) of the shorter one;
a pair belongs to the block whose range holds i and to no other.  Blocks of more than ``most`` words halve their
range until it is one character, where no more words than some 200 can differ.

In a block the words (reversed where the start is free) are sorted.  One banded row of the edit matrix (three cells, as the
distance is one) is kept per query and shared prefix; neighbouring longest common prefixes say where a range of words
parts, so a row is computed once for all words below it, and a range whose row exceeds one edit is left out as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import free_name, tidied, written

#: A run of letters; A-Z are lower-cased before.
LETTERS = "[a-zÀ-ÿ]"


def count_words(docs: DataFrame, shortest: int = 7, rarest: int = 2, typo_every: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the letter runs of all texts with at least ``shortest`` characters and ``rarest`` occurrences.

    Runs are maximal, A-Z lower-cased.  With ``typo_every``, a run whose crc32 h of ``<id>:<run>`` it divides loses its
    character h % length (0: none does).  Null texts hold no words; a null id counts as the empty text; repeated rows count each.
    """

    def run(batches):
        import re
        from collections import Counter
        from zlib import crc32

        import pyarrow as pa

        find = re.compile(f"{LETTERS}{{{shortest},}}").findall

        def rows(counts):
            return pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        counts: dict = {}
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for i in range(b.num_rows):
                text = texts[i].as_py()
                if not text:
                    continue
                seed = crc32(f"{ids[i].as_py() or ''}:".encode())
                for word, n in Counter(find(text.encode().lower().decode())).items():
                    if typo_every:
                        h = crc32(word.encode(), seed)
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < shortest:
                                continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > 200_000:
                    yield rows(counts)
                    counts = {}
        yield rows(counts)

    found = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidied(run), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rarest)


def _key(word: Column, m: Column, lo: Column, hi: Column) -> Column:
    """Hash of what lies outside [lo, hi) of the shorter word."""
    n = F.length(word)
    return F.xxhash64(m, lo, hi, F.substring(word, F.lit(1), lo), F.when(hi < m, F.substring(word, n - (m - hi) + 1, m - hi)).otherwise(""))


def _blocks(words: DataFrame, most: int) -> DataFrame:
    """Rows (key, m, lo, hi, text, n), a word once per block; ``text`` is reversed if the block shares no start."""
    word, m, half = F.col("word"), F.col("m"), F.floor(F.col("m") / 2).cast("int")
    lengths = F.array(F.length("word"), F.length("word") - 1)
    rows = words.select("word", "n", F.explode(lengths).alias("m")).filter("m > 0")
    free = F.array(F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), (m + 1).alias("hi")))
    rows = rows.select("word", "n", "m", F.explode(free).alias("r")).select("word", "n", "m", "r.lo", "r.hi")
    rows = rows.withColumn("key", _key(word, m, F.col("lo"), F.col("hi")))
    done = None
    while True:
        hot = written(rows.filter("hi - lo > 1").groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > most).select("key"), "hot_blocks")
        if hot.isEmpty():
            break
        cold = rows.join(hot, "key", "left_anti").select(*rows.columns)
        done = cold if done is None else done.unionByName(cold)
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(F.struct(F.col("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi")))
        rows = rows.join(hot, "key", "left_semi").withColumn("r", F.explode(halves)).select("word", "n", "m", "r.lo", "r.hi")
        rows = written(rows.withColumn("key", _key(word, m, F.col("lo"), F.col("hi"))), "split_blocks")
    rows = rows if done is None else done.unionByName(rows.select(*done.columns))
    return rows.select("key", "m", "lo", "hi", F.when(F.col("lo") == 0, F.reverse("word")).otherwise(F.col("word")).alias("text"), "n")


def one_edit_pairs(words: list[str], blocks: list[tuple[int, int, int, int]]):
    """Index pairs (query, other), both ways, of the pairs at distance one in each block (first word, end, m, shared characters).

    The words of a block are distinct, sorted and share that many first characters; only pairs whose shorter word has m characters count.
    """
    import numpy as np

    n = len(words)
    size = np.fromiter(map(len, words), np.int64, n)
    at = np.concatenate(([0], np.cumsum(size)))[:-1]
    chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    chars = np.append(chars, np.uint32(0)).astype(np.int64)

    def char(i, d):
        """Character d of word i, -1 outside of it."""
        ok = (d >= 0) & (d < size[i])
        return np.where(ok, chars[np.where(ok, at[i] + d, 0)], -1)

    start = np.zeros(n, bool)
    shared = np.zeros(n, np.int64)  # by block
    of = np.zeros(n, np.int64)
    for j, (a, b, m, s) in enumerate(blocks):
        start[a], shared[a:b], of[a:b] = True, s, m
    lcp = np.where(start, -1, shared)  # with the word before
    open_ = np.flatnonzero(~start)
    while len(open_):
        d = lcp[open_]
        x = char(open_, d)
        open_ = open_[(x == char(open_ - 1, d)) & (x >= 0)]
        lcp[open_] += 1

    lo = np.concatenate([np.full(b - a, a, np.int64) for a, b, _, _ in blocks])
    hi = np.concatenate([np.full(b - a, b, np.int64) for a, b, _, _ in blocks])
    q, depth = np.arange(n), shared.copy()
    # cells of the row: distance of the first depth characters to the query's first depth - 1, depth and depth + 1
    row = np.stack([np.where(depth > 0, 1, 2), np.zeros(n, np.int64), np.where(depth < size, 1, 2)]).astype(np.int8)
    pairs = []
    for d in range(int(depth.min(initial=0)), int(size.max(initial=0)) + 1):
        now = depth == d
        if not now.any():
            if not len(depth):
                break
            continue
        rest = [x[..., ~now] for x in (q, lo, hi, depth, row)]
        q, lo, hi, row = q[now], lo[now], hi[now], row[:, now]
        ends = size[lo] == d  # the shortest word of a range comes first
        if ends.any():
            gap = size[q] - d + 1
            near = ends & (gap >= 0) & (gap <= 2) & (np.minimum(size[q], d) == of[q])
            near[near] = row[gap[near], np.flatnonzero(near)] == 1
            pairs.append(np.stack([q[near], lo[near]]))
            lo = lo + ends
        more = hi > lo
        q, lo, hi, row = q[more], lo[more], hi[more], row[:, more]
        cuts = np.flatnonzero(lcp == d)
        first = np.searchsorted(cuts, lo, "right")
        parts = np.searchsorted(cuts, hi, "left") - first + 1
        state = np.repeat(np.arange(len(q)), parts)
        step = np.arange(len(state)) - np.repeat(np.cumsum(parts) - parts, parts)
        below = cuts[np.minimum(first[state] + step - 1, len(cuts) - 1)] if len(cuts) else lo[state]
        above = cuts[np.minimum(first[state] + step, len(cuts) - 1)] if len(cuts) else hi[state]
        lo2 = np.where(step == 0, lo[state], below)
        hi2 = np.where(step == parts[state] - 1, hi[state], above)
        q2, old = q[state], row[:, state]
        c = char(lo2, np.full(len(lo2), d))
        left = np.minimum(old[0] + (c != char(q2, np.full(len(q2), d - 1))), old[1] + 1)
        left = np.where(d <= size[q2], left, 2)
        mid = np.minimum(np.minimum(old[1] + (c != char(q2, np.full(len(q2), d))), old[2] + 1), left + 1)
        mid = np.where(d + 1 <= size[q2], mid, 2)
        right = np.minimum(old[2] + (c != char(q2, np.full(len(q2), d + 1))), mid + 1)
        right = np.where(d + 2 <= size[q2], right, 2)
        new = np.minimum(np.stack([left, mid, right]), 2).astype(np.int8)
        keep = (new.min(axis=0) < 2) & ~((hi2 - lo2 == 1) & (lo2 == q2))
        q, lo, hi, row = (np.concatenate([rest[0], q2[keep]]), np.concatenate([rest[1], lo2[keep]]), np.concatenate([rest[2], hi2[keep]]), np.concatenate([rest[4], new[:, keep]], axis=1))
        depth = np.concatenate([rest[3], np.full(int(keep.sum()), d + 1, np.int64)])
    return np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)


def near_words(words: DataFrame, most: int = 50_000) -> DataFrame:
    """Rows (word, near, near_n), one per word and word at distance one (so each pair twice), of distinct (word, n)."""

    def run(batches):
        import pyarrow as pa

        def finish(rows):
            blocks, a = [], 0
            while a < len(rows):
                _, m, lo, hi, text, _ = rows[a]
                # what a block shares at its sorted end; foreign words of an equal hash stand apart
                s = max(m - hi, 0) if lo == 0 else lo
                b = a + 1
                while b < len(rows) and rows[b][:4] == rows[a][:4] and rows[b][4][:s] == text[:s]:
                    b += 1
                blocks.append((a, b, m, s))
                a = b
            q, near = one_edit_pairs([r[4] for r in rows], blocks).tolist()
            out = []
            for x, y in zip(q, near):
                _, _, lo, hi, one, _ = rows[x]
                other = rows[y][4]
                if lo == 0:
                    one, other = one[::-1], other[::-1]
                if one[:hi] != other[:hi]:  # else another block has the pair
                    out.append((one, other, rows[y][5]))
            cols = list(zip(*out)) or [(), (), ()]
            return pa.record_batch([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=["word", "near", "near_n"])

        rows: list = []
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(6))):
                if len(rows) > 20_000 and r[0] != rows[-1][0]:
                    yield finish(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield finish(rows)

    blocks = _blocks(words, most)
    return blocks.repartition("key").sortWithinPartitions("key", "m", "lo", "hi", "text").mapInArrow(tidied(run), "word string, near string, near_n long")


def group_variants(words: DataFrame, factor: int = 10, most: int = 50_000) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct (word, n).

    form is the near word (distance one) of largest n, the smaller word of equal ones, if that n is at least ``factor`` times the word's own;
    else null, as is form_n.  root follows the forms to the last; the word itself if it has none.  Words without a near one
    have n_near 0.  An empty table gives no row; null words and further columns are left out.  ``most`` bounds a block in memory.
    """
    words = written(words.select("word", "n").filter("word is not null"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    of = near_words(words, most).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("b"))
    linked = words.join(of, "word", "left").withColumn("fits", -F.col("b.less") >= factor * F.col("n"))
    forms = written(
        linked.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.expr("if(fits, b.word, null)").alias("form"), F.expr("if(fits, -b.less, null)").alias("form_n")),
        "forms",
    )
    # every step multiplies n by the factor, so the number of doublings is known
    last = words.agg(F.max("n")).first()[0] or 1
    steps, n = 1, 1
    while n < last and factor > 1:
        n, steps = n * factor, steps + 1
    reach = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(steps.bit_length()):
        far = reach.select(F.col("word").alias("root"), F.col("root").alias("far"))
        reach = written(reach.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root")), "roots")
    return forms.join(reach, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_root(docs_words: DataFrame, groups: DataFrame, word_col: str = "word") -> DataFrame:
    """``docs_words`` with a column root: that of the word in ``groups``, the word itself where it isn't there (null: null)."""
    w = free_name(docs_words, "_word")
    r = free_name(docs_words, "_root")
    known = groups.filter("word <> root").select(F.col("word").alias(w), F.col("root").alias(r))
    rest = [c for c in docs_words.columns if c.lower() != "root"]
    return docs_words.join(known, F.col(word_col) == F.col(w), "left").select(*rest, F.coalesce(r, word_col).alias("root"))
