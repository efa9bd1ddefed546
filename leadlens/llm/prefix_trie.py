"""Prefix trie of conversations by whole-sequence collapse.

Identical conversations become one weighted sequence with the list of its members; a sequence that is a proper prefix of
another is no leaf (anti-join with the prefixes); every node's counts are sums over the weighted sequences that pass through
it.  Turns travel as a 128-bit digest and a length, never as text; a prefix is known by the exclusive or of its turns'
hashes, each mixed with its depth (two 64-bit lanes).

A conversation has no size bound, so nothing is done per whole conversation: turns are ranked over range partitions, and
running values are taken in blocks of ``BLOCK`` turns whose totals are carried on.

Sums over a subtree take each node once: a node is owned by the least conversation through it, which then owns all
its deeper nodes too; a conversation's running sum of owned values, added up over the conversations through a node, is the
node's subtree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.llm.common import text_of, tidied, written

#: Turns of a conversation that are summed in one group.
BLOCK = 4096
#: Ids in one row of the member lists.
LIST = 4096
#: A parent of more than one in this many nodes is looked up by broadcast, so that at most this many rows are.
HOT = 5000


def ranked_turns(convs: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, digest, chars): every turn's place in its conversation, from 0.

    Order: turn (null first), then the digest of role and text.  A null role or text becomes empty; rows with a null id belong to no conversation and are
    left out; repeated rows are turns of their own; other columns are left out.  Ranges of (id, turn, digest) are numbered each, and a conversation
    that goes on in the next range is shifted there (no more rows to shift by than ranges).
    """
    role, text = text_of(role_col), text_of(text_col)
    rows = convs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )

    def run(batches):
        import numpy as np
        import pyarrow as pa

        last, seen = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            conv = b.column(0).to_numpy(zero_copy_only=False)
            new = np.append(True, conv[1:] != conv[:-1])
            if conv[0] == last:
                new[0] = False
            starts = np.flatnonzero(new)
            at = np.arange(len(conv))
            base = np.full(len(conv), -seen)
            if len(starts):
                base = np.where(at < starts[0], -seen, np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(conv)]]))))
            pos = at - base
            last, seen = conv[-1], int(pos[-1]) + 1
            yield pa.record_batch([b.column(0), pa.array(pos, pa.int64()), b.column(2), b.column(3)], names=["conv_id", "pos", "digest", "chars"])

    dealt = rows.repartitionByRange("conv_id", F.asc_nulls_first("turn"), "digest").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "digest")
    local = written(dealt.mapInArrow(tidied(run), "conv_id long, pos long, digest binary, chars long").withColumn("part", F.spark_partition_id()), "ranked")
    counts = local.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.withColumn("shift", before).filter("shift is not null").select("conv_id", "part", "shift")
    return local.join(F.broadcast(shift), ["conv_id", "part"], "left").select("conv_id", (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos"), "digest", "chars")


def rebuild_forks(turns: DataFrame, base: Column, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one: (turns, conversations) from ranked turns.

    Conversation c takes the first ``shared`` (at most ``most``) turns of conversation ``base``, all if that has fewer and none if it is absent, then
    its own turns after its first ``shared``.  ``base`` and ``shared`` are expressions of conv_id.  The second table holds every
    conv_id, also those left without a turn.
    """
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).select("conv_id", "own", base.cast("long").alias("base"), shared.cast("long").alias("shared"))
    bases = convs.select(F.col("base").alias("conv_id")).distinct()
    first = turns.filter(F.col("pos") < most).join(bases, "conv_id", "left_semi")
    heads = first.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "chars"))).alias("head")).withColumnRenamed("conv_id", "base")
    forks = written(convs.join(heads, "base", "left").select("conv_id", "own", "shared", F.coalesce(F.expr("slice(head, 1, int(shared))"), F.expr("array()")).alias("head")), "forks")
    taken = forks.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.digest", "t.chars")
    # a fork of a short base moves its own turns up; the others keep their places
    blocks = F.explode(F.sequence(F.lit(0), F.floor(F.col("own") / BLOCK))).alias("block")
    short = forks.filter(F.size("head") < F.col("shared")).select("conv_id", (F.col("shared") - F.size("head")).alias("up"), blocks)
    own = turns.withColumns({"shared": shared.cast("long"), "block": F.floor(F.col("pos") / BLOCK)}).filter("pos >= shared").join(short, ["conv_id", "block"], "left")
    own = own.select("conv_id", (F.col("pos") - F.coalesce("up", F.lit(0))).alias("pos"), "digest", "chars")
    return taken.unionByName(own), forks.select("conv_id")


def _running(rows: DataFrame, values: dict[str, Column], fold: str) -> DataFrame:
    """``rows`` (conv_id, pos, ...) with the running ``fold`` (sum or bit_xor) of ``values`` along pos, block by block."""
    agg = getattr(F, fold)
    join = (lambda a, b: a + b) if fold == "sum" else (lambda a, b: a.bitwiseXOR(b))
    rows = rows.withColumn("block", F.floor(F.col("pos") / BLOCK)).withColumns({f"_{k}": v for k, v in values.items()})
    within = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy("conv_id", "block").agg(*[agg(f"_{k}").alias(f"_{k}") for k in values])
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("conv_id", "block", *[agg(f"_{k}").over(before).alias(f"_c_{k}") for k in values]).filter("block > 0")
    inner = rows.withColumns({k: agg(f"_{k}").over(within) for k in values})
    out = inner.join(carry, ["conv_id", "block"], "left").withColumns({k: join(F.col(k), F.coalesce(f"_c_{k}", F.lit(0))) for k in values})
    return out.drop("block", *[f"_{k}" for k in values], *[f"_c_{k}" for k in values])


def collapse(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sequences, prefixes, wholes): the distinct sequences, a row per turn of each, and the sequence of each conversation.

    sequences: k1, k2, depth (of the whole sequence), conv_id (its least member), weight (members), leaf (1 if it is no proper
    prefix of another).  prefixes: conv_id, depth, k1, k2 (of the first depth turns), p1, p2 (of the first depth - 1), chars of the last turn,
    weight, leaf.  wholes: conv_id, depth, k1, k2.
    """
    lanes = {f"k{i}": F.xxhash64(F.lit(i), F.col("pos"), F.col("digest")) for i in (1, 2)}
    keyed = _running(turns, lanes, "bit_xor").withColumn("depth", F.col("pos") + 1)
    keyed = written(keyed.select("conv_id", "depth", "k1", "k2", *[F.col(f"k{i}").bitwiseXOR(lanes[f"k{i}"]).alias(f"p{i}") for i in (1, 2)], "chars"), "prefixes")
    whole = keyed.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2")).alias("w"))
    whole = written(convs.join(whole, "conv_id", "left").select("conv_id", *[F.coalesce(f"w.{c}", F.lit(0)).cast("long").alias(c) for c in ("depth", "k1", "k2")]), "wholes")
    sequences = whole.groupBy("depth", "k1", "k2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"))
    proper = keyed.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).distinct()
    leaves = sequences.join(proper, ["depth", "k1", "k2"], "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    sequences = written(sequences.join(leaves, "conv_id", "left").withColumn("leaf", F.coalesce("leaf", F.lit(0)).cast("long")), "sequences")
    # a long conversation meets its sequence in as many groups as it has blocks
    info = sequences.select("conv_id", "weight", "leaf", F.explode(F.sequence(F.lit(0), F.floor(F.col("depth") / BLOCK))).alias("block"))
    prefixes = keyed.withColumn("block", F.floor(F.col("depth") / BLOCK)).join(info, ["conv_id", "block"]).drop("block")
    return sequences, written(prefixes, "sequence_prefixes"), whole


def trie_nodes(sequences: DataFrame, prefixes: DataFrame) -> DataFrame:
    """One row per node: k1, k2, depth, conv_id (least member), parent_conv_id (root: null), n_convs, n_children, n_leaves and
    saved_tokens (over the subtree, a node's (n_convs - 1) times the characters of its last turn)."""
    top = sequences.agg(F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves")).filter("conv_id is not null")
    root = top.select("conv_id", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("k1", "k2")], *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")], F.lit(0).cast("long").alias("chars"), "n_convs", "n_leaves")
    first = [F.first(c).alias(c) for c in ("p1", "p2", "chars")]
    below = prefixes.groupBy("depth", "k1", "k2").agg(F.min("conv_id").alias("conv_id"), *first, F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"))
    nodes = written(root.unionByName(below), "nodes")
    # what each conversation owns, summed from its end: total minus what lies before
    owned = nodes.filter("n_convs > 1 and chars > 0").select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("value"))
    rows = prefixes.select("conv_id", "depth", "k1", "k2").join(owned, ["conv_id", "depth"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    rows = _running(rows.withColumn("pos", F.col("depth") - 1), {"upto": F.col("value")}, "sum")
    total = owned.groupBy("conv_id").agg(F.sum("value").alias("total"))
    blocks = sequences.select("conv_id", F.explode(F.sequence(F.lit(0), F.floor(F.col("depth") / BLOCK))).alias("block"))
    total = blocks.join(total, "conv_id")
    rows = rows.withColumn("block", F.floor(F.col("depth") / BLOCK)).join(total, ["conv_id", "block"])
    saved = rows.groupBy("depth", "k1", "k2").agg(F.sum(F.col("total") - F.col("upto") + F.col("value")).alias("saved_tokens"))
    saved = saved.unionByName(owned.agg(F.sum("value").alias("saved_tokens")).select(*[F.lit(0).cast("long").alias(c) for c in ("depth", "k1", "k2")], "saved_tokens"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    key = ["depth", "k1", "k2"]
    full = nodes.join(children, key, "left").join(saved, key, "left")
    full = written(full.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_children", "saved_tokens")}), "full_nodes")
    # parents of very many children are few and broadcast; of the others no group is larger than one in HOT of the nodes
    crowd = full.count() / HOT
    parents = full.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "n_children").filter("n_children > 0")
    up = ["depth", "p1", "p2"]
    hot = parents.filter(F.col("n_children") > crowd).withColumnRenamed("parent_conv_id", "hot_parent").drop("n_children")
    mild = parents.filter(F.col("n_children") <= crowd).drop("n_children")
    marked = full.join(F.broadcast(hot), up, "left")
    found = marked.filter("hot_parent is not null or depth = 0").withColumn("parent_conv_id", F.col("hot_parent"))
    rest = marked.filter("hot_parent is null and depth > 0").join(mild, up, "left")
    return found.select(*full.columns, "parent_conv_id").unionByName(rest.select(*full.columns, "parent_conv_id"))


def member_lists(whole: DataFrame) -> DataFrame:
    """Rows (depth, k1, k2, first, ids): the conversations that are the whole sequence, ascending, in lists of at most ``LIST``."""
    key = ["depth", "k1", "k2"]

    def run(batches):
        import pyarrow as pa

        names = [*key, "first", "ids"]
        types = [pa.int64()] * 4 + [pa.list_(pa.int64())]
        now, ids = None, []
        for b in batches:
            out = []
            for *k, c in zip(*(b.column(i).to_pylist() for i in range(4))):
                if k != now or len(ids) == LIST:
                    if ids:
                        out.append((*now, ids[0], ids))
                    now, ids = k, []
                ids.append(c)
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        if ids:
            yield pa.record_batch([pa.array([v], t) for v, t in zip((*now, ids[0], ids), types)], names=names)

    rows = whole.select(*key, "conv_id")
    schema = "depth long, k1 long, k2 long, first long, ids array<long>"
    return rows.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(tidied(run), schema)


def list_digests(lists: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): SHA-256 of a node's ids, comma-joined; the lists stream through one after the other."""
    key = ["depth", "k1", "k2"]

    def run(batches):
        import hashlib

        import pyarrow as pa

        now, sha = None, None

        def rows(out):
            return pa.record_batch([pa.array([r[i] for r in out], pa.int64() if i < 3 else pa.string()) for i in range(4)], names=[*key, "ends_sha256"])

        for b in batches:
            out = []
            for *k, ids in zip(*(b.column(i).to_pylist() for i in range(4))):
                text = ",".join(map(str, ids)).encode()
                if k == now:
                    sha.update(b"," + text)
                else:
                    if now is not None:
                        out.append((*now, sha.hexdigest()))
                    now, sha = k, hashlib.sha256(text)
            if out:
                yield rows(out)
        if now is not None:
            yield rows([(*now, sha.hexdigest())])

    dealt = lists.repartition(*key).sortWithinPartitions(*key, "first").select(*key, "ids")
    return dealt.mapInArrow(tidied(run), "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the conversations whose ranked turns (conv_id, pos from 0 without gaps, digest, chars) are given.

    nodes: see ``trie_nodes``; the root (depth 0) is there as soon as there is a conversation.  ends: see ``member_lists``; the
    conversations that end in a node, in lists that follow each other by ``first``.  ``convs`` (conv_id) names conversations without a turn,
    too.  An empty table gives no node.
    """
    convs = turns.select("conv_id").distinct() if convs is None else convs
    sequences, prefixes, whole = collapse(turns, convs)
    return trie_nodes(sequences, prefixes), member_lists(whole)


def with_last_turn(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with the digest and length of their last turn (root: null)."""
    last = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "digest", "chars")
    return nodes.drop("digest", "chars").join(last, ["conv_id", "depth"], "left")
