"""Fixtures of the operators' tests: rows with nulls, repeats, ties, long texts and clashing columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"


def words(rng: random.Random, n: int) -> str:
    syllables = "an be co de er fi go ha in ka lo mu ne or pa re st tion un wh".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """doc_id, text and columns that operators use as names of their own."""
    rng = random.Random(5)
    base = [words(rng, rng.randint(5, 120)) for _ in range(30)]
    texts = base + base[:6]  # exact copies
    texts += [t.replace(t.split()[3], "changed", 1) for t in base[6:12]]  # near copies
    texts += [None, "", "   ", "\n\n", "One", "one", "Ä é ñ ß 日本語 \U0001f600", words(rng, 6000), base[0] + "\n" + base[1] + "\n\n" + base[0]]
    rows = [(i, t, "x", i, "y", float(i)) for i, t in enumerate(texts)]
    rows += [(None, "no id here at all", "x", 0, "y", 0.0), (3, base[3], "x", 3, "y", 3.0), (3, "same id, other text", "x", 3, "y", 3.0)]
    schema = "doc_id long, text string, ids string, start int, _hash string, score double"
    return spark.createDataFrame(rows, T._parse_datatype_string(schema)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, ids string, start int, _hash string, score double")
