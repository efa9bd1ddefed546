"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from leadlens.llm import spelling
from leadlens.llm.queries import QUERIES

from .conftest import SF


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_words(rows, shortest=7, rarest=2, every=31) -> dict:
    counts: Counter = Counter()
    for doc_id, text in rows:
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= rarest}


def brute_groups(words: dict, factor=10) -> list:
    form = {}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def rows_of(df) -> list:
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_pairs_of_sorted_lists():
    rng = random.Random(1)
    for _ in range(200):
        s = rng.choice([0, 0, 1, 3])
        m = rng.randint(max(1, s), 7)
        words = sorted({"xyz"[:s] + "".join(rng.choice("abé") for _ in range(rng.choice([m, m + 1]) - s)) for _ in range(rng.randint(1, 50))})
        got = sorted(map(tuple, spelling.one_edit_pairs(words, [(0, len(words), m, s)]).T.tolist()))
        ids = range(len(words))
        assert got == sorted((i, j) for i in ids for j in ids if one_edit(words[i], words[j]) and min(len(words[i]), len(words[j])) == m)


@pytest.mark.parametrize("most", [50_000, 3, 0])
def test_groups_of_random_words(spark, most):
    rng = random.Random(4)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))): rng.choice([2, 3, 20, 30, 300, 300, 5000]) for _ in range(120)}
    words |= {"ÿ×÷çé" + "x" * i: 10 ** (1 + i % 4) for i in range(6)} | {"long" * 40: 2, "long" * 40 + "s": 40}
    df = spark.createDataFrame([(w, n, "x") for w, n in words.items()] + [(None, 5, "x")], "word string, n long, near string").repartition(3)
    assert rows_of(spelling.group_variants(df, most=most)) == brute_groups(words)


def test_words_of_odd_documents(spark, odd_docs, no_docs):
    got = {r.word: r.n for r in spelling.count_words(odd_docs, shortest=3).collect()}
    assert got == brute_words([(r.doc_id, r.text) for r in odd_docs.collect()], shortest=3)
    assert spelling.count_words(no_docs).count() == 0
    assert spelling.group_variants(spelling.count_words(no_docs)).count() == 0


def test_root_of_words(spark):
    groups = spark.createDataFrame([("colour", "color"), ("color", "color")], "word string, root string")
    rows = spark.createDataFrame([("colour", 1, "x"), ("color", 2, "x"), ("other", 3, "x"), (None, 4, "x")], "word string, i int, _word string")
    assert [r.root for r in spelling.with_root(rows, groups).orderBy("i").collect()] == ["color", "color", "other", None]


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(QUERIES["op13_spelling"](spark, SF)) == brute_groups(brute_words([tuple(r) for r in rows]))
