"""SimHash, line de-duplication and vectors against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from leadlens.llm import embedding_dedup, line_dedup, simhash
from leadlens.llm.common import components


def groups(n: int, links) -> list[int]:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def fingerprint(text: str | None, k: int = 3) -> int:
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 150: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_tree_edges_connect_all_links():
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(6)]
    codes = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (1 << 64) - 1 for b in base for _ in range(25)})
    edges = simhash.tree_edges(np.array(codes[20:], np.uint64), np.array(codes[:20], np.uint64), 3)
    assert len(edges) < len(codes)
    place = {c: i for i, c in enumerate(codes)}
    want = [(i, j) for i in range(len(codes)) for j in range(max(i + 1, 20), len(codes)) if (codes[i] ^ codes[j]).bit_count() <= 3]
    assert groups(len(codes), want) == groups(len(codes), [(place[a], place[b]) for a, b in edges])


@pytest.mark.parametrize("target,split", [(64, 4096), (0, 4096), (64, 2)])
def test_fingerprint_links(spark, target, split):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(40)]
    codes = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(6)})
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    got = simhash.fingerprint_links(spark.createDataFrame([(c,) for c in signed], "fp long"), 3, target, split).collect()
    place = {c: i for i, c in enumerate(signed)}
    want = [(i, j) for i in range(len(codes)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 3]
    assert groups(len(codes), want) == groups(len(codes), [(place[e.u], place[e.v]) for e in got])
    assert all((e.u ^ e.v & (1 << 64) - 1) & (1 << 64) - 1 for e in got)


def test_simhash_of_odd_documents(spark, odd_docs, no_docs):
    rows = odd_docs.collect()
    fps = [fingerprint(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    root = groups(len(rows), links)
    ids: dict = {}
    for r, g in zip(rows, root):
        ids.setdefault(g, []).append(r.doc_id)
    want = sorted((str(r.doc_id), f"{f:016x}", str(min([i for i in ids[g] if i is not None], default=None))) for r, f, g in zip(rows, fps, root))
    got = simhash.simhash_components(odd_docs)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got.collect()) == want
    kept = simhash.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(min([i for i in v if i is not None], default=None)) for v in ids.values())
    assert simhash.simhash_components(no_docs).count() == 0 and simhash.keep_one_of_each(no_docs).count() == 0


def shingles(line: str) -> frozenset:
    w = line.lower().split()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute_lines(rows: list[tuple]) -> dict:
    """(id, text) in order to (kept text, lines, removed)."""
    seen: list = []
    out = {}
    for key, text in dict.fromkeys(rows):
        if text is None:
            out[key, text] = (None, 0, 0)
            continue
        lines, kept = text.split("\n"), []
        for line in lines:
            s = shingles(line)
            if not line.split():
                kept.append(line)
                continue
            if not any(s == t or len(s & t) >= 0.8 * len(s | t) for t in seen):
                kept.append(line)
            seen.append(s)
        out[key, text] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def test_line_dedup_of_a_large_group(spark):
    """Lines with a common core that mostly don't match the earliest of them, in documents with clashing column names."""
    rng = random.Random(17)
    core = [f"core{i}" for i in range(14)]
    lines = []
    for i in range(150):
        words = list(core)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"own{rng.randrange(12)}"
        lines.append(" ".join(words + [f"tail{rng.randrange(4)}"] * rng.randint(0, 2)))
    rows = [(i, "\n".join(lines[3 * i : 3 * i + 3]), "a", "b") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _d_ string, _h string").repartition(4)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    want = {i: kept for (i, _), (kept, _, _) in brute_lines([r[:2] for r in rows]).items()}
    assert got == want and 20 < sum(t.count("core13") for t in want.values()) < 140


def test_line_dedup_of_odd_documents(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    base = [" ".join(rng.choice("ab cd ef gh ij kl mn op qr st uv wx".split()) + str(rng.randint(0, 9)) for _ in range(rng.randint(3, 40))) for _ in range(25)]

    def edit(line):
        w = line.split()
        w[rng.randrange(len(w))] = "edit" + str(rng.randint(0, 99))
        return " ".join(w).upper() if rng.random() < 0.3 else "  ".join(w)

    made = [(1000 + i, "\n".join(rng.choice([line, edit(line), edit(edit(line)), ""]) for line in rng.choices(base, k=8))) for i in range(60)]
    docs = odd_docs.select("doc_id", "text", "start").unionByName(spark.createDataFrame([(i, t, 0) for i, t in made], "doc_id long, text string, start int"))
    order = docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).orderBy("doc_id", "h").collect()
    want = brute_lines([(r.doc_id, r.text) for r in order])
    got = line_dedup.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "start", "n_lines", "n_removed"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()), key=key) == sorted(((r.doc_id, *want[r.doc_id, r.text]) for r in order), key=key)
    assert sum(v[2] for v in want.values()) > 100
    assert line_dedup.dedup_lines(no_docs).count() == 0


@pytest.mark.parametrize("block", [1024, 7])
def test_near_vectors(spark, block, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((20, 16))
    x = np.concatenate([base, base[:8] + 0.05 * rng.standard_normal((8, 16)), np.repeat(base[:1], 30, axis=0) + 0.03 * rng.standard_normal((30, 16)), base[2:4] * 3, rng.standard_normal((60, 16))])
    x = x.astype(np.float32)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    rows += [(500, None, 0), (501, [], 0), (502, [0.0] * 16, 0), (503, [float("nan")] * 16, 0), (504, [None] * 16, 0), (505, [1.0, 2.0], 0), (506, [1.0, 2.0], 0), (507, [float("inf")] + [1.0] * 15, 0)]
    rows += [rows[5], (None, rows[9][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    good = [k for k, r in enumerate(rows) if r[1] and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    unit = {k: np.array(rows[k][1], np.float64) / np.linalg.norm(np.array(rows[k][1], np.float64)) for k in good}
    links = [(a, b) for a in good for b in good if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    root = groups(len(rows), links)
    degree = [sum(k in e for e in links) for k in range(len(rows))]
    ids: dict = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            ids[root[k]] = min(ids.get(root[k], r[0]), r[0])
    want = sorted((str(r[0]), degree[k], str(ids.get(root[k])), r[0] == ids.get(root[k])) for k, r in enumerate(rows))
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in embedding_dedup.near_vectors(df).collect())
    assert got == want
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("dim", [5, 64, 100])
def test_members_without_a_near_one_leave_by_their_codes(spark, dim):
    """No pair above the threshold loses a member, and most others go before any vector travels."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(dim)
    base = rng.standard_normal((300, dim))
    near = base[:20] + 0.02 * rng.standard_normal((20, dim))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([*base, *near])]
    df = spark.createDataFrame(rows, "node long, vector array<double>")
    coded = embedding_dedup._coded(df, dim, 6, 1, 3)
    met = coded.drop("keys").select(F.lit(0).alias("t"), F.lit(0).cast("long").alias("key"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "*")
    stay = {r.node for r in embedding_dedup._hopeful(met, dim, 0.95).collect()}
    assert stay >= {*range(20), *range(300, 320)}
    assert dim < 64 or len(stay) < 320
    assert embedding_dedup._hopeful(met.limit(0), dim, 0.95).count() == 0
