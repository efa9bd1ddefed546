"""Encoding, packing and the token store against the tokenizers library on whole texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leadlens.llm.encoding import PieceEncoder
from leadlens.llm.packing import VectorPacker, pack_documents
from leadlens.llm.token_store import read_token_store, write_token_store
from leadlens.session import scratch_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n", "it's  I'LL  don't\n\n x\t y \x1c z\x85q　r  ", "a'sB 'S ３４ ½ ́ é éx", "<|endoftext|> hi<|startoftext|>", "\r\n \r\n a   \n  b",
    "ΣΑΣ ΟΔΟΣ. İstanbul ǅ", "日本語 テキスト。", "x" * 3000 + " 'll", "a |b|\n| c", "\n\xa0\x0b-", "End.\nStart, of: it\n",
]


def library(path: str, text: str) -> list[int]:
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_equal_whole_texts(path):
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    rng = random.Random(1)
    chars = list(" \t\n\x0b\r\x1c\x85\xa0 　'sdmabZééΣİÅ1１½_.-!&<|>한​\U0001f600")
    texts = ODD + ["".join(rng.choices(chars, k=rng.randint(1, 30))) for _ in range(1500)]
    encoder = PieceEncoder(path, most=40)  # forgets all the time
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids + [1], repr(text)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_a_word_is_computed_once_whatever_marks_follow(path):
    encoder, asked = PieceEncoder(path), []
    model = encoder.model

    class Counted:
        def tokenize(self, word):
            asked.append(word)
            return model.tokenize(word)

    encoder.model = Counted()
    text = "so word, été. word### été%%% word!? word_ word"
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library(path, text) + [1]
    assert len(asked) == 3


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_added_tokens_as_the_library_does(path):
    tok = Tokenizer.from_file(path)
    rng = random.Random(2)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "|>", " ", "\n", "  ", "a", "word", "É", "\x1c", "\U0001f600"]
    texts = ODD + ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(500)]
    for text, ids in zip(texts, PieceEncoder(path, most=40, added=True).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids + [1], repr(text)


def test_added_tokens_in_packing_and_store(spark):
    docs = spark.createDataFrame([(1, "one <|endoftext|> two<|startoftext|>"), (2, "plain")], "doc_id long, text string")
    ids = {p: [*Tokenizer.from_file(p).encode("one <|endoftext|> two<|startoftext|>", add_special_tokens=False).ids, 1] for p in (BYTE, WORD)}
    got = [r for r in pack_documents(docs, BYTE, seq_len=64).collect() if r.doc_id == 1]
    assert b"".join(r.ids for r in sorted(got, key=lambda r: r.start)) == np.array(ids[BYTE], "<u4").tobytes() and 50256 in ids[BYTE]
    path = scratch_path(spark, "store")
    write_token_store(docs, path, WORD, seq_len=32, batch_rows=4)
    rows = {r.doc_id: r for r in read_token_store(spark, path).collect()}
    assert bytes(rows[1].ids) == np.array(ids[WORD], "<u4").tobytes() and {49406, 49407} <= set(ids[WORD])
    assert (rows[1].n_tokens, rows[2].start) == (len(ids[WORD]), len(ids[WORD]))


def test_packer_keeps_limits_and_loses_nothing():
    rng = random.Random(3)
    packer = VectorPacker(64, 5, 40, pool=32)
    sizes = {k: (n := rng.randint(1, 200), rng.randint(0, n)) for k in range(400)}
    out = [p for k, (n, quiet) in sizes.items() for p in packer.add(k, n, quiet)] + list(packer.finish())
    seen: dict = {}
    bins: dict = {}
    for key, start, n, loss, seq, at, whole in out:
        seen.setdefault(key, []).append((start, n))
        quiet = max(0, min(n, sizes[key][1] - start))
        assert loss == n - quiet
        bins.setdefault(seq, []).append((at, n, loss, whole))
    for key, (n, _) in sizes.items():
        parts = sorted(seen[key])
        assert [s for s, _ in parts] == list(np.cumsum([0] + [m for _, m in parts[:-1]])) and sum(m for _, m in parts) == n
    for parts in bins.values():
        parts.sort()
        assert [a for a, *_ in parts] == list(np.cumsum([0] + [p[1] for p in parts[:-1]]))
        total = sum(p[1] for p in parts)
        assert total <= 64 and len(parts) <= 5 and sum(p[2] for p in parts) <= 40
        assert {p[3] for p in parts} == {total if total & (total - 1) == 0 else 64}


def test_packing_of_odd_documents(spark, odd_docs, no_docs):
    rows = pack_documents(odd_docs, BYTE, seq_len=256).collect()
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd_docs.collect())
    assert sum(r.length for r in rows) == sum(len(library(BYTE, t)) + 1 for *_, t in texts)
    whole = {(none, i): [] for none, i, _ in texts}
    for r in sorted(rows, key=lambda r: r.start):
        whole[(r.doc_id is None, r.doc_id or 0)].append(r)
        assert len(r.ids) == 4 * r.length
    for (none, i), parts in whole.items():
        own = [t for n, k, t in texts if (n, k) == (none, i)]
        if len(own) == 1:
            assert b"".join(p.ids for p in parts) == np.array(library(BYTE, own[0]) + [1], "<u4").tobytes()
    filled: dict = {}
    for r in rows:
        filled.setdefault((r.sequence_id, r.sequence_length), 0)
        filled[r.sequence_id, r.sequence_length] += r.length
    assert len(filled) == len({s for s, _ in filled})
    assert sum(size for _, size in filled) - sum(filled.values()) <= 0.01 * sum(filled.values())
    assert pack_documents(no_docs, BYTE).count() == 0


def test_prompts_bear_no_loss(spark):
    df = spark.createDataFrame([(1, "a question of some words", "an answer"), (2, None, "alone")], "doc_id long, prompt string, text string")
    rows = pack_documents(df, BYTE, seq_len=64, prompt_col="prompt", max_loss_tokens=16).collect()
    loss = {i: sum(r.loss_tokens for r in rows if r.doc_id == i) for i in (1, 2)}
    assert loss == {1: len(library(BYTE, "an answer")) + 1, 2: len(library(BYTE, "alone")) + 1}


def test_token_store_round_trip(spark, odd_docs, no_docs):
    path = scratch_path(spark, "store")
    write_token_store(odd_docs, path, WORD, seq_len=32, batch_rows=4)
    got = read_token_store(spark, path).withColumn("crc", F.crc32("ids")).orderBy("start").collect()
    order = odd_docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).orderBy("doc_id", "h").collect()
    start = 0
    for g, r in zip(got, order, strict=True):
        ids = library(WORD, r.text or "") + [1]
        assert (g.doc_id, g.start, g.n_tokens) == (r.doc_id, start, len(ids))
        assert g.crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    path = scratch_path(spark, "store")
    write_token_store(no_docs, path, WORD)
    assert read_token_store(spark, path).count() == 0
