"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by Burkhard-Keller trees.

Fingerprints are dealt to shards by bit blocks: of ``max_distance + agree`` blocks, two fingerprints within the
distance have at least ``agree`` equal ones, so each choice of ``agree`` blocks and their value is a shard and no link
is lost.  In a shard, a tree whose children are keyed by their integer Hamming distance to the parent is searched along
the edges within the radius only.  The shard trees travel with the shuffle, as the fingerprints of all documents
must not be broadcast.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.llm.common import components, free_name, text_of, tidied, written

#: A null id takes this place where rows are matched.
NO_ID = -(1 << 63)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, text_hash, fp) per row of ``docs``.

    A-Z are lower-cased; words are runs without ASCII white space; shingles of ``shingle`` words (repeats count), or
    the whole sequence if shorter, are hashed by XXH64 with seed 42; a bit is 1 if set in over half the hashes.  Without
    a word, and for a null text, the fingerprint is 0.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("text_hash", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        def one(text: str) -> int:
            words = text.encode().lower().split()
            if not words:
                return 0
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            k = min(shingle, len(words))
            counts, total = np.zeros(64, np.int64), len(words) - k + 1
            for lo in range(0, total, 1 << 16):
                hi = min(lo + (1 << 16), total)
                h = [xxh64_intdigest(line[s:e], 42) for s, e in zip(starts[lo:hi].tolist(), ends[lo + k - 1 : hi + k - 1].tolist())]
                bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                counts += bits.sum(axis=0, dtype=np.int64)
            return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])

        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                yield pa.record_batch([part.column(0), part.column(1), pa.array([one(t) for t in part.column(2).to_pylist()], pa.int64())], names=["doc_id", "text_hash", "fp"])

    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(tidied(run), schema)


def tree_edges(members, visitors, radius: int) -> list[tuple[int, int]]:
    """Links within ``radius`` that connect ``members`` (distinct unsigned fingerprints) among themselves and with
    ``visitors``: a spanning forest, so never more links than fingerprints.

    Tree and search go down together: a node takes the first of its members, deals the others to children by their
    distance to it, and hands each child only the queries whose own distance is within the radius of the child's edge.
    """
    import numpy as np

    nodes = np.concatenate([members, visitors])
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges = []
    stack = [(np.arange(len(members)), np.arange(len(nodes)))]
    while stack:
        inside, queries = stack.pop()
        node = int(inside[0])
        far = np.bitwise_count(nodes[queries] ^ nodes[node])
        for x in queries[far <= radius].tolist():
            a, b = find(node), find(x)
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((node, x))
        inside = inside[1:]
        if len(inside):
            edge = np.bitwise_count(nodes[inside] ^ nodes[node])
            for e in np.unique(edge).tolist():
                near = queries[np.abs(far.astype(np.int16) - e) <= radius]
                stack.append((inside[edge == e], near))
    return [(int(nodes[a]), int(nodes[b])) for a, b in edges]


def fingerprint_links(fps: DataFrame, max_distance: int = 3, target: int = 64, split_over: int = 4096) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints of column ``fp`` within ``max_distance`` bits.

    The number of agreeing blocks follows the count of fingerprints, so that a shard of evenly spread ones holds about
    ``target``; any choice gives the same components.  A shard of over ``split_over`` is dealt out once more by the first edges
    of its tree: ring e holds the fingerprints at distance e from the root and is visited by those of the rings within the
    radius below it.
    """
    n = fps.count()
    agree = 1
    while agree < 4 and n >> (64 * agree // (max_distance + agree)) > target:
        agree += 1
    blocks = max_distance + agree
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [(1 << (b - a)) - 1 << a for a, b in zip(cuts, cuts[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    keys = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(sum(masks[i] for i in some)))).alias("k")) for t, some in enumerate(combinations(range(blocks), agree))]
    dealt = fps.select("fp", F.explode(F.array(*keys)).alias("s")).select("fp", "s.t", "s.k")
    shards = dealt.groupBy("t", "k").agg(F.count("*").alias("n"), F.min("fp").alias("top")).filter("n > 1")
    d = F.expr("bit_count(fp ^ top)")
    ring = F.when(F.col("n") > split_over, F.sequence(d, d + max_distance)).otherwise(F.array(F.lit(-1)))
    rows = dealt.join(shards, ["t", "k"]).select("t", "k", "fp", F.posexplode(ring).alias("below", "ring"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        key, fp, below = None, [], []

        def finish():
            if len(fp) == 2 and 0 in below:
                a, b = fp
                return [(a, b)] if ((a ^ b) & (1 << 64) - 1).bit_count() <= max_distance else []
            u, away = np.array(fp, np.int64).view(np.uint64), np.array(below) > 0
            if len(u) < 2 or away.all():
                return []
            got = np.array(tree_edges(u[~away], u[away], max_distance), np.uint64).reshape(-1, 2).view(np.int64)
            return list(map(tuple, got.tolist()))

        out = []
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(5)]
            for t, k, r, x, w in zip(*cols):
                if (t, k, r) != key:
                    out += finish()
                    key, fp, below = (t, k, r), [], []
                fp.append(x)
                below.append(w)
            if out:
                yield pa.record_batch([pa.array([e[0] for e in out], pa.int64()), pa.array([e[1] for e in out], pa.int64())], names=["u", "v"])
                out = []
        out += finish()
        if out:
            yield pa.record_batch([pa.array([e[0] for e in out], pa.int64()), pa.array([e[1] for e in out], pa.int64())], names=["u", "v"])

    return rows.select("t", "k", "ring", "fp", "below").repartition("t", "k", "ring").sortWithinPartitions("t", "k", "ring", "below", "fp").mapInArrow(tidied(run), "u long, v long")


def simhash_components(docs: DataFrame, shingle: int = 3, max_distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp, fingerprint (16 hex digits), component_id, keep_hash.

    component_id is the smallest id reachable by links, the document's own included (null ids count only where a component has no
    other); (component_id, keep_hash) names the document that stays.  Texts without words have fingerprint 0 and
    link like any other.  Repeated rows have one component; an empty table gives no row; other columns are ignored.
    """
    fps = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    distinct = written(fps.groupBy("fp").agg(first), "distinct_fingerprints")
    linked = components(fingerprint_links(distinct.select("fp"), max_distance))
    rooted = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    of_fp = rooted.join(best, "root").select("fp", F.col("best.doc_id").alias("component_id"), F.col("best.text_hash").alias("keep_hash"))
    return fps.join(of_fp, "fp").select("doc_id", "text_hash", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "keep_hash")


def keep_one_of_each(docs: DataFrame, shingle: int = 3, max_distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id (of a repeated id, the row with the smaller text hash; of
    repeated rows, any one)."""
    comp = simhash_components(docs, shingle, max_distance, id_col, text_col)
    i, h = free_name(docs, "_id"), free_name(docs, "_hash")
    stay = comp.groupBy(F.coalesce(F.col("component_id"), F.lit(NO_ID)).alias(i), F.col("keep_hash").alias(h)).agg(F.count("*").alias("n")).drop("n")
    keyed = docs.withColumn(i, F.coalesce(F.col(id_col), F.lit(NO_ID))).withColumn(h, F.xxhash64(text_of(text_col)))
    return keyed.join(stay, [i, h], "left_semi").dropDuplicates([i, h]).select(docs.columns)
