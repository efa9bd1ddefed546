"""Near-duplicate vectors by randomised-rotation binary codes (RaBitQ, Gao and Long 2024).

A unit vector is rotated and coded by its signs; the stored factor, the inner product of the vector with its code's, makes the
estimate of an inner product from a code unbiased, with an error of known spread.  The pairs looked at are those whose signs under further
rotations agree in one of many tables, as for every pair at the threshold with probability 0.9999.

Buckets first get codes, factors and a few bits of each rotated component alone: estimates are counts of common bits, and a member stays if the
estimate and bound of one of its pairs reach the threshold.  Vectors follow to their buckets for members that stay, whose pairs are
estimated again from the code and recomputed in double precision.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.llm.common import components, tidied, written

#: Members of a bucket that one task compares at once; a larger bucket is dealt out as pairs of such blocks.
BLOCK = 1024
#: Standard deviations of the estimate's error that the bound allows.
EPSILON = 5.0
#: Bits of a rotated component in the first comparison; what rounding to them can change is added to the bound.
PLANES = 6


def tables_for(n: int, threshold: float, miss: float = 1e-4) -> tuple[int, int]:
    """(bits, tables): bits follow the count of vectors, so that a bucket holds less than one other vector by chance, and the tables are as many as
    a pair at the threshold needs to meet with probability 1 - ``miss``."""
    same = 1 - math.acos(threshold) / math.pi
    bits = max(6, min(60, math.ceil(math.log2(max(n, 2))) + 1))
    return bits, math.ceil(math.log(miss) / math.log1p(-(same**bits)))


def rotations(dim: int, rows: int, seed: int):
    """``rows`` rows of random orthogonal matrices; the first ``dim`` are one rotation."""
    import numpy as np

    rng = np.random.default_rng(seed)
    out = []
    for _ in range(-(-rows // dim)):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        out.append((q * np.sign(np.diag(r))).T)
    return np.concatenate(out)[:rows]


def _coded(distinct: DataFrame, dim: int, bits: int, tables: int, seed: int) -> DataFrame:
    """(node, code, factor, planes, low, step, error, keys) of each vector: signs and factor under the first rotation, its components rounded to
    low + step * (PLANES bits, one plane after the other) with the norm of what that changes, and bucket keys under the other rotations."""
    kinds = {"node": T.LongType(), "code": T.BinaryType(), "factor": T.DoubleType(), "planes": T.BinaryType(), "low": T.DoubleType(), "step": T.DoubleType(), "error": T.DoubleType()}
    schema = T.StructType([*[T.StructField(n, k) for n, k in kinds.items()], T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        turn = rotations(dim, dim * (1 + -(-tables * bits // dim)), seed)
        place = np.int64(1) << np.arange(bits, dtype=np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                x = part.column(1).flatten().to_numpy().reshape(-1, dim).copy()
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                y = x @ turn.T
                code = np.packbits(y[:, :dim] > 0, axis=1)
                factor = np.abs(y[:, :dim]).sum(axis=1) / math.sqrt(dim)
                signs = (y[:, dim : dim + tables * bits] > 0).reshape(-1, tables, bits)
                keys = signs @ place
                own = y[:, :dim]
                low = own.min(axis=1)
                step = np.maximum((own.max(axis=1) - low) / ((1 << PLANES) - 1), 1e-300)
                few = np.rint((own - low[:, None]) / step[:, None]).astype(np.uint8)
                error = np.linalg.norm(own - (low[:, None] + step[:, None] * few), axis=1)
                planes = np.packbits((few[:, None, :] >> np.arange(PLANES, dtype=np.uint8)[None, :, None]) & 1, axis=2)
                head = [part.column(0), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(factor), pa.array([c.tobytes() for c in planes], pa.binary())]
                yield pa.record_batch([*head, pa.array(low), pa.array(step), pa.array(error), pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * tables, pa.int32()), pa.array(keys.ravel(), pa.int64()))], names=schema.names)

    return distinct.select("node", "vector").mapInArrow(tidied(run), schema)


def _slack(factor, dim: int):
    """The estimate's bound, ``EPSILON`` standard deviations."""
    import numpy as np

    return EPSILON * np.sqrt(np.maximum(1 - factor * factor, 0)) / factor / math.sqrt(max(dim - 1, 1))


def _by_bucket(batches, width: int):
    """Whole buckets (equal first ``width`` columns) as record batches; a bucket may go on in the next batch."""
    import numpy as np
    import pyarrow as pa

    carry = None
    for b in batches:
        whole = pa.Table.from_batches([b] if carry is None else [carry, b]).combine_chunks()
        if not whole.num_rows:
            continue
        whole = whole.to_batches()[0]
        ids = np.stack([whole.column(k).to_numpy(zero_copy_only=False) for k in range(width)], axis=1)
        last = np.flatnonzero((ids != ids[-1]).any(axis=1))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield whole.slice(0, cut)
        carry = whole.slice(cut)
    if carry is not None and carry.num_rows:
        yield carry


def _hopeful(rows: DataFrame, dim: int, threshold: float) -> DataFrame:
    """Of the members (t, key, i, j, side, node, ...) of buckets those that stay: one of their pairs may reach the threshold by its codes."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        size = -(-dim // 8)
        words = -(-size // 8)

        def bits(column, planes):
            """Rows of 64-bit words, plane after plane."""
            raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, planes, size)
            out = np.zeros((len(raw), planes, 8 * words), np.uint8)
            out[:, :, :size] = raw
            return out.view(np.uint64).reshape(len(raw), planes, words)

        for b in _by_bucket(batches, 4):
            ids = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in range(4)], axis=1).astype(np.int64)
            edge = np.concatenate([[0], np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1, [len(ids)]])
            left = np.repeat(edge[1:], np.diff(edge)) - 1 - np.arange(len(ids))
            side = np.where(ids[:, 2] == ids[:, 3], -1, b.column(4).to_numpy(zero_copy_only=False)).astype(np.int64)
            code, planes = bits(b.column(6), 1)[:, 0], bits(b.column(8), PLANES)
            factor, low, step, error = (b.column(c).to_numpy(zero_copy_only=False) for c in (7, 9, 10, 11))
            ones = np.bitwise_count(code).sum(axis=1).astype(float)
            weight = (1 << np.arange(PLANES)).astype(float)
            total = low * dim + step * (np.bitwise_count(planes).sum(axis=2) @ weight)  # sum of the rounded components
            slack = _slack(factor, dim)
            stays = np.zeros(len(ids), bool)
            for lag in range(1, int(left.max()) + 1 if len(left) else 1):
                a = np.flatnonzero(left >= lag)
                a = a[(side[a] != side[a + lag]) | (side[a] < 0)]
                for lo in range(0, len(a), 200_000):
                    x = a[lo : lo + 200_000]
                    y = x + lag
                    common = np.bitwise_count(code[x][:, None, :] & planes[y]).sum(axis=2) @ weight
                    signed = 2 * (low[y] * ones[x] + step[y] * common) - total[y]
                    near = signed / (math.sqrt(dim) * factor[x]) + slack[x] + error[y] / factor[x] >= threshold
                    stays[x[near]] = True
                    stays[y[near]] = True
            yield b.filter(pa.array(stays)).select(["t", "key", "i", "j", "side", "node"])

    order = ["t", "key", "i", "j"]
    rows = rows.select(*order, "side", "node", "code", "factor", "planes", "low", "step", "error")
    schema = T.StructType([rows.schema[c] for c in (*order, "side", "node")])
    return rows.repartition(*order).sortWithinPartitions(*order, "node").mapInArrow(tidied(run), schema)


def _compared(rows: DataFrame, dim: int, threshold: float, seed: int) -> DataFrame:
    """Buckets to (node, links, root): the copies linked to a vector in this bucket that no earlier table has met, and the smallest node
    that it reaches inside the bucket.  Pairs never leave the task."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        turn = rotations(dim, dim, seed)

        def bucket(data):
            node, copies, side, own, unit, signs, factor, keys, left = data
            n = len(node)
            links, root = np.zeros(n, np.int64), np.arange(n)

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            slack = _slack(factor, dim)
            turned = unit @ turn.T

            def decide(a, b):
                keep = np.flatnonzero((side[a] != side[b]) | (side[a] < 0))
                for lo in range(0, len(keep), 200_000):
                    i, j = a[keep[lo : lo + 200_000]], b[keep[lo : lo + 200_000]]
                    estimate = np.einsum("ij,ij->i", signs[i], turned[j]) / (math.sqrt(dim) * factor[i])
                    near = estimate + slack[i] >= threshold
                    i, j = i[near], j[near]
                    exact = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
                    i, j = i[exact], j[exact]
                    met = keys[i] == keys[j]
                    new = met.argmax(axis=1) == own[i]
                    i, j = i[new], j[new]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    apart = root[i] != root[j]  # equal ones are joined already
                    for x, y in zip(i[apart].tolist(), j[apart].tolist()):
                        p, q = find(x), find(y)
                        if p != q:
                            root[max(p, q)] = min(p, q)

            top = int(left.max()) if n else 0
            for lag in range(1, top + 1):
                a = np.flatnonzero(left >= lag)
                decide(a, a + lag)
            roots = np.array([find(x) for x in range(n)], np.int64)
            some = (links > 0) | (roots != np.arange(n))
            return node[some], links[some], node[roots[some]]

        def run_of(table):
            cols = {c: table.column(k) for k, c in enumerate(table.schema.names)}
            num = lambda c: cols[c].to_numpy(zero_copy_only=False)
            unit = cols["vector"].flatten().to_numpy().reshape(-1, dim).copy()
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            bits = np.unpackbits(np.frombuffer(b"".join(cols["code"].to_pylist()), np.uint8).reshape(len(unit), -1), axis=1)[:, :dim]
            ids = np.stack([num("t"), num("key"), num("i"), num("j")], axis=1).astype(np.int64)
            edge = np.concatenate([[0], np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1, [len(ids)]])
            left = np.repeat(edge[1:], np.diff(edge)) - 1 - np.arange(len(ids))
            side = np.where(ids[:, 2] == ids[:, 3], -1, num("side")).astype(np.int64)
            keys = cols["keys"].flatten().to_numpy().reshape(len(unit), -1)
            return bucket((num("node"), num("copies"), side, ids[:, 0], unit, 2.0 * bits - 1, num("factor"), keys, left))

        def emit(batch):
            node, links, root = run_of(batch)
            return pa.record_batch([pa.array(node, pa.int64()), pa.array(links, pa.int64()), pa.array(root, pa.int64())], names=["node", "links", "root"])

        for b in _by_bucket(batches, 4):
            yield emit(b)

    order = ["t", "key", "i", "j"]
    rows = rows.select(*order, "side", "node", "copies", "vector", "code", "factor", "keys")
    return rows.repartition(*order).sortWithinPartitions(*order, "node").mapInArrow(tidied(run), "node long, links long, root long")


def near_vectors(vectors: DataFrame, threshold: float = 0.95, seed: int = 7, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other rows at cosine ``threshold`` or more), component_id (smallest id
    reachable by links), kept (whether that is its own).

    Null, empty and zero vectors and those with null or non-finite components link with nothing, nor do vectors of different
    lengths with each other.  Equal vectors are compared once and count each.  Null ids link, too; their own component, if it holds no other,
    has a null id.  Repeated rows count as rows; an empty table gives no row; other columns are ignored.
    """
    v = F.col(vec_col)
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(fine, F.transform(v, lambda x: x.cast("double") + F.lit(0.0))).alias("vector"))
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    distinct = written(rows.filter("node is not null").groupBy("node").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")), "vectors")
    found = []
    for size in distinct.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).orderBy("dim").collect():
        dim, n = size["dim"], size["n"]
        own = distinct.filter(F.size("vector") == dim)
        bits, tables = tables_for(n, threshold)
        coded = written(_coded(own, dim, bits, tables, seed), "codes")
        dealt = coded.select("node", F.posexplode("keys").alias("t", "key"))
        full = dealt.groupBy("t", "key").agg(F.count("*").alias("m")).filter("m > 1")
        met = dealt.join(full, ["t", "key"])
        # a bucket over BLOCK members is dealt as the pairs (i, j) of its blocks
        blocks = F.ceil(F.col("m") / BLOCK).cast("int")
        met = met.withColumn("blocks", blocks).withColumn("side", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
        met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = met.select("t", "key", "node", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
        stay = written(_hopeful(met.join(coded.drop("keys"), "node"), dim, threshold), "hopeful")
        payload = own.select("node", "copies", "vector").join(coded.select("node", "code", "factor", "keys"), "node")
        found.append(_compared(stay.join(payload, "node"), dim, threshold, seed))
    out = rows.select("vec_id", "node")
    if not found:
        return out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = found[0]
    for f in found[1:]:
        links = links.unionByName(f)
    links = written(links, "links")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    nodes = distinct.select("node", "first", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = nodes.groupBy("root").agg(F.min("first").alias("component"))
    nodes = nodes.join(smallest, "root").join(counts, "node", "left").select("node", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = out.join(nodes, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
