"""The prefix trie against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from leadlens.llm import prefix_trie
from leadlens.llm.queries import QUERIES

from .conftest import SF



def digest(role, text) -> str:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows) -> list:
    """Node rows (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends) of (conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(turns.get(c - c % 100, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(set)
    for s in members:
        if s:
            kids[s[:-1]].add(s)
    leaves, saved = defaultdict(int), defaultdict(int)
    for s in members:
        value = (len(members[s]) - 1) * len(s[-1][1]) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += not kids[s]
            saved[s[:d]] += value
    out = []
    for s, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if built[c] == s)
        out.append((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(kids[s]), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df) -> list:
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.select(cols).collect()), key=str)


def talk(rng, n, longest) -> list:
    rows = []
    for c in [*range(n), *range(100, 100 + n, 2), 305, 701]:
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, 3, None]), rng.choice(["user", "bot", None]), rng.choice(["hi", "hé 日本", "", None, "bye now"])))
    return rows + rows[:5] + [(None, 0, "user", "no id"), (2, 9, "a", "bc"), (2, 9, "ab", "c")]


@pytest.mark.parametrize("block,size,hot", [(4096, 4096, 5000), (2, 2, 2)])
def test_random_conversations(spark, monkeypatch, tmp_path, block, size, hot):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "LIST", size)
    monkeypatch.setattr(prefix_trie, "HOT", hot)
    rng = random.Random(3)
    rows = talk(rng, 30, 7) + [(50, t, "user", "again") for t in range(40)] + [(51, t, "user", "again") for t in range(40)]
    rows += [(c, 0, "user", "same") for c in range(400, 420)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pos int").repartition(5)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    assert found(QUERIES["op12_prefix_trie"](spark, str(tmp_path))) == brute(rows)


def test_ranks_go_on_over_ranges(spark):
    rows = [(1, t, "u", f"t{t}") for t in range(500)] + [(c, t, "u", "x") for c in (0, 2, 3) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = prefix_trie.ranked_turns(df).collect()
    assert sorted((r.conv_id, r.pos) for r in got) == sorted((c, t) for c, t, *_ in rows)
    want = {digest("u", f"t{t}"): t for t in range(500)}
    assert all(want[r.digest.hex()] == r.pos for r in got if r.conv_id == 1)


def test_empty_and_last_turns(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    turns = prefix_trie.ranked_turns(none)
    nodes, ends = prefix_trie.prefix_trie(turns)
    assert nodes.count() == 0 and ends.count() == 0
    some = prefix_trie.ranked_turns(spark.createDataFrame([(1, 0, "u", "hello"), (2, 0, "u", "hello"), (2, 1, "b", "x")], none.schema))
    nodes, ends = prefix_trie.prefix_trie(some)
    assert sorted((r.depth, r.chars) for r in prefix_trie.with_last_turn(nodes, some).filter("depth > 0").collect()) == [(1, 5), (2, 1)]
    assert sorted((r.depth, r.ids) for r in ends.collect()) == [(1, [1]), (2, [2])]


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(QUERIES["op12_prefix_trie"](spark, SF)) == brute([tuple(r) for r in rows])
