"""The registered queries and the pipeline on the smallest tables, against SQL or brute force."""

from __future__ import annotations

import hashlib
import os
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leadlens.llm import secrets
from leadlens.llm.queries import ORACLE, QUERIES
from tests.oracle_util import _close, _rows, duck

from .conftest import SF
from .test_pairs import brute_lines, fingerprint, groups
from .test_rows import brute_secrets, edits

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    got, want = _rows(QUERIES[name](spark, SF).toPandas()), _rows(duck(SF).execute(ORACLE[name]).df())
    assert len(got) == len(want) and all(_close(a, b) for a, b in zip(got, want))


def ids_of(name: str, text: str) -> bytes:
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    return np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()


def test_packing_query(spark, docs):
    rows = QUERIES["op2_packing"](spark, SF).collect()
    ids = {i: ids_of("byte_bpe_50k.json", d.text) for i, d in docs.items()}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)]) and r.doc_tokens == len(ids[r.doc_id]) // 4
    assert sum(r.length for r in rows) == sum(map(len, ids.values())) // 4
    assert len({(r.doc_id, r.start) for r in rows}) == len(rows)
    total: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == total.get(r.sequence_id, 0)
        total[r.sequence_id] = r.offset + r.length
    assert max(total.values()) <= 2048
    assert sum(0 if n & (n - 1) == 0 else 2048 - n for n in total.values()) <= 0.01 * sum(total.values())


def test_token_store_query(spark, docs):
    start = 0
    for r in QUERIES["op8_token_store"](spark, SF).orderBy("doc_id").collect():
        ids = ids_of("word_bpe_49k.json", docs[r.doc_id].text)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        start += r.n_tokens


def test_secrets_query(spark, docs):
    for r in QUERIES["op7_secrets"](spark, SF).collect():
        base = [f"{k}:{s}:{e}" for s, _, e, k in brute_secrets(docs[r.doc_id].text or "")]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("markov")] == base
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b.startswith(k) for b in base) for k, *_ in secrets.BASE)


def test_simhash_query(spark, docs):
    ids = sorted(docs)
    fps = [fingerprint(docs[i].text) for i in ids]
    root = groups(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, SF).collect())
    assert got == [(i, f"{f:016x}", ids[g]) for i, f, g in zip(ids, fps, root)]


def test_toxicity_query(spark, docs):
    rows = QUERIES["op5_toxicity"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_pipeline_stages_in_effect(spark, docs):
    import corpus_pipeline as P

    assert P.ORACLE_SQL is None and [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "simhash", "decontamination", "packing"]
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, " ".join(r.text.lower().split())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rejected = {r.doc_id for r in QUERIES["op5_toxicity"](spark, SF).collect() if r.predicted}
    now = {r.doc_id: r.text for r in frame.collect()}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, frame, SF)
        assert out.columns == frame.columns
        got = {r.doc_id: r.text for r in out.collect()}
        assert out.count() == len(got)
        if name == "toxicity":
            want = {i: t for i, t in now.items() if i not in rejected}
        elif name == "line_dedup":
            want = {i: v[0] for (i, _), v in brute_lines(sorted(now.items())).items()}
            assert all(r.n_chars == len(r.text) for r in out.collect())
        elif name == "simhash":
            ids = sorted(now)
            fps = [fingerprint(now[i]) for i in ids]
            root = groups(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
            want = {i: now[i] for k, i in enumerate(ids) if root[k] == k}
        else:
            texts = {i: " ".join(t.lower().split()) for i, t in now.items()}
            exact = {i for i, t in texts.items() if any(b in t for _, b in bench)}
            assert not exact & set(got)
            for i in set(now) - set(got) - exact:
                assert any(edits(b, texts[i]) <= 0.1 * len(b) for _, b in bench)
            want = {i: now[i] for i in got}
        assert got == want, name
        frame, now = spark.createDataFrame(out.collect(), out.schema), got
    rows = P.STAGES[-1][1](spark, frame, SF).collect()
    parts: dict = {}
    for r in sorted(rows, key=lambda r: r.start):
        parts[r.doc_id] = parts.get(r.doc_id, b"") + bytes(r.ids)
    assert parts == {i: ids_of("byte_bpe_50k.json", t) for i, t in now.items()}
    whole = P.run(spark, SF)
    assert {r.doc_id for r in whole.select("doc_id").collect()} == set(now)


def test_entry_has_them():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert len([n for n in entry.queries() if re.match(r"op\d+_", n)]) == 13
