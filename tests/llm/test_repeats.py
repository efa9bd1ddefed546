"""Repeated byte strings against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.llm import repeats
from leadlens.llm.queries import QUERIES

from .conftest import SF, words


def shared(a: bytes, b: bytes) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def brute(rows, length=100) -> list:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text) rows."""
    docs = [(i, (t or "").encode()) for i, t in rows]
    docs.sort(key=lambda d: (d[0] is None, d[0] or 0, hashlib.md5(d[1]).digest()))
    least: dict = {}  # the smallest id of a text decides its place
    for i, t in docs:
        least.setdefault(t, (i is None, i or 0, hashlib.md5(t).digest()))
    docs.sort(key=lambda d: (least[d[1]], d[0] is None, d[0] or 0))
    seen: set = set()
    out = []
    for i, t in docs:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for p in range(len(t)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def found(docs, length=100, gram=40, most=50_000) -> list:
    copies, texts = repeats.cut_texts(docs, length, gram, most)
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    digests = texts.select("doc", "first", n.alias("n_removed"), F.size("spans").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    return sorted(map(tuple, repeats.removed_bytes(copies, digests, length).collect()), key=str)


@pytest.mark.parametrize("width,shallow", [(12, 8), (40, 16), (40, 0), (9, 64)])
def test_sorted_order_and_prefixes(width, shallow):
    rng = random.Random(width)
    for _ in range(60):
        base = [bytes(rng.choice([0, 97, 98]) for _ in range(width)) for _ in range(4)]
        text = [rng.choice(base)[: rng.randint(0, width)] + bytes([rng.choice([0, 97])] * rng.randint(0, 1)) for _ in range(rng.randint(1, 50))]
        text = [t[:width] for t in text]
        order, lcp = repeats.deep_shallow_sort(text, width, shallow)
        got = [text[i] for i in order]
        assert sorted(order) == list(range(len(text)))
        assert all(lcp[i] == shared(got[i - 1], got[i]) for i in range(1, len(got)))
        for d in range(1, width + 1):  # a prefix is one run
            runs = [g[:d] for g, n in zip(got, np.append(True, lcp[1:] < d)) if n and len(g) >= d]
            assert len(runs) == len(set(runs))


def test_blind_trie_sorts():
    rng = random.Random(8)
    text = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(300)]
    got = repeats.blind_trie(list(range(300)), text)
    assert [text[i] for i, _ in got] == sorted(text)


def test_every_window_has_an_anchor():
    rng = random.Random(5)
    for kinds in (b"ab", bytes(range(256)), b"a"):
        data = np.frombuffer(bytes(rng.choice(kinds) for _ in range(2000)), np.uint8)
        ends = [700, 750, 2000]
        at = set(repeats.gram_anchors(data, ends, 100, 40)[0].tolist())
        for lo, hi in zip([0, *ends], ends):
            assert all(any(a in at for a in range(p, p + 61)) for p in range(lo, hi - 99))


@pytest.mark.parametrize("most,piece", [(50_000, 1 << 20), (2, 1 << 20), (50_000, 300)])
def test_random_documents(spark, monkeypatch, most, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    rng = random.Random(6)
    parts = [words(rng, rng.randint(3, 12)) for _ in range(14)] + ["ab" * 80, "z" * 130, "é日" * 30]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(40)]
    texts += texts[:5] + [texts[3][i:] for i in (1, 40, 99)] + [None, "", "short", "short", "q" * 99, "q" * 100, "q" * 100]
    rows = [(rng.choice([i, i + 3, None]), t, 1, "x", "y") for i, t in enumerate(texts)] + [(7, texts[7], 1, "x", "y")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, pos int, doc string, kept string").repartition(4)
    assert found(df, most=most) == brute([r[:2] for r in rows])
    assert found(df, length=30, gram=10, most=most) == brute([r[:2] for r in rows], 30)


def test_odd_and_empty_documents(spark, odd_docs, no_docs):
    assert found(odd_docs) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert found(no_docs) == []
    assert repeats.drop_repeats(no_docs).count() == 0


def test_dropped_repeats(spark):
    a, b = "first passage, " * 9, "x" + "second, other passage " * 8
    rows = [(1, a, "p"), (2, "head " + a + "tail", "q"), (2, "head " + a + "tail", "q"), (3, b, "r"), (4, b, "s"), (5, None, "t"), (6, "é", "u")]
    got = {r.doc_id: (r.text, r._doc) for r in repeats.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string, _doc string")).collect()}
    assert got[4] == ("", "s") and got[5] == (None, "t") and got[6] == ("é", "u")
    assert got[2] == ("headtail", "q")  # the blank before the passage stands within it, too
    want = brute([r[:2] for r in rows])
    for i in (1, 3):
        assert hashlib.sha256(got[i][0].encode()).hexdigest() in [w[4] for w in want if w[0] == i]


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_suffix_dedup"](spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute([tuple(r) for r in rows])
