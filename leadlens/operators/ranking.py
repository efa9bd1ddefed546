"""ROC-AUC of many score columns of the same rows, without a row per score.

Each task sorts the scores of its rows per variant (group and place in the array) and class, and writes the distinct ones with their counts as packed
arrays, one per score range.  A range of a variant is merged in one task; the ranges' counts, a few rows per variant, are added up in order.  Counts are
integers, so the result does not depend on the ranges or on the split of the rows.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# tasks need no installed copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Scores that a task sorts at once.
AT_ONCE = 4_000_000


def _codes(columns):
    """A number per row that is the same for equal rows of ``columns`` (nulls equal), and the first row of each number."""
    import pyarrow.compute as pc

    if not columns:
        return None, None
    code = 0
    for c in columns:
        d = pc.dictionary_encode(c, null_encoding="encode")
        code = code * max(1, len(d.dictionary)) + d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, first, number = np.unique(code, return_index=True, return_inverse=True)
    return number, first


def _distinct(values, bounds):
    """Of scores sorted between ``bounds``: the distinct ones, their counts (int32) and the bounds among them."""
    if not len(values):
        return values, np.zeros(0, np.int32), bounds
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][bounds[:-1] < len(values)]] = True
    at = np.flatnonzero(new)
    return values[at], np.diff(np.append(at, len(values))).astype(np.int32), np.searchsorted(at, bounds)


def _chunks(table, n_by: int, n_scores: int, cuts):
    """Packed rows of a task's rows (by..., label, scores): by..., place, range, and per class the distinct scores and their counts."""
    import pyarrow as pa

    values = table.column(n_by + 1).combine_chunks()
    flat = values.flatten()
    scores = flat.to_numpy(zero_copy_only=False)
    if values.null_count or flat.null_count or len(flat) != table.num_rows * n_scores or np.isnan(scores).any():
        raise ValueError("probability is NULL or NaN")
    scores = scores.reshape(table.num_rows, n_scores)
    label = table.column(n_by).to_numpy()  # NaN where null
    by = [table.column(i).combine_chunks() for i in range(n_by)]
    number, first = _codes(by)
    first = np.zeros(1, np.int64) if first is None else first
    groups, ranges = len(first), len(cuts) + 1
    cells = groups * n_scores * ranges
    packed, sizes = [], np.zeros(cells, np.int64)
    for wanted in (1, 0):
        parts, bounds, done = [], [np.zeros(1, np.int64)], 0
        for g in range(groups):
            mine = label == wanted
            rows = scores[mine if number is None else mine & (number == g)]
            for i in range(n_scores):
                own = np.sort(rows[:, i])
                parts.append(own)
                bounds.append(done + np.append(np.searchsorted(own, cuts, side="left"), len(own)))
                done += len(own)
        distinct, counts, at = _distinct(np.concatenate(parts), np.concatenate(bounds).astype(np.int64))
        sizes += np.diff(at)
        for data, width in ((distinct, 8), (counts, 4)):
            offsets = (at * width).astype(np.int32)
            packed.append(pa.BinaryArray.from_buffers(pa.binary(), cells, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]))
    cell = np.arange(cells)
    keep = pa.array(np.flatnonzero((sizes > 0) | (cell % ranges == 0)))  # a variant without labels has a row all the same
    group = pa.array(first[cell // (n_scores * ranges)])
    columns = [c.take(group) for c in by] + [pa.array((cell // ranges % n_scores).astype(np.int32)), pa.array((cell % ranges).astype(np.int32)), *packed]
    return [c.take(keep) for c in columns]


def _merged(columns):
    """(positives, negatives, twice the pairs won) of the packed scores of one range."""
    scores, weights = [], []
    for i in (0, 1):
        value, count = (np.frombuffer(b"".join(columns[2 * i + j].to_pylist()), t) for j, t in ((0, np.float64), (1, np.int32)))
        scores.append(value)
        weights.append(count.astype(np.int64))
    value = np.concatenate(scores)
    pos, neg = (np.concatenate([w if i == j else np.zeros(len(w), np.int64) for j, w in enumerate(weights)]) for i in (0, 1))
    order = np.argsort(value, kind="stable")
    value, pos, neg = value[order], pos[order], neg[order]
    if len(value):
        at = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        pos, neg = np.add.reduceat(pos, at), np.add.reduceat(neg, at)
    p, n = int(pos.sum()), int(neg.sum())
    if p * n >= 2**61:  # beyond 64 bits
        pos, neg = pos.astype(object), neg.astype(object)
    below = np.cumsum(neg) - neg
    return p, n, int((pos * (2 * below + neg)).sum())


def roc_aucs(df: DataFrame, names: Sequence[str], cuts: Sequence[float], label: str = "y", scores: str = "scores", by: Sequence[str] = (), name: str = "variant") -> DataFrame:
    """(by, ``name``, roc_auc): for each group, the ROC-AUC of each place of the array ``scores``; ``names`` are the places' names.

    The figures are those of ``evaluate.roc_auc`` (ties count half; null with one class alone; rows without a label are left out, a NULL or NaN score
    fails the job).  ``cuts`` cut the scores into ranges (see ``evaluate.score_ranges``); any cuts give the same figures."""
    by, n_scores, edges = list(by), len(names), np.array(sorted(cuts), np.float64)
    rows = df.select(*by, F.col(label).cast("double").alias("_label"), F.col(scores).cast("array<double>").alias("_scores"))
    kinds = [rows.schema[c] for c in by]
    places = [T.StructField("_place", T.IntegerType()), T.StructField("_range", T.IntegerType())]
    packed = [T.StructField(c, T.BinaryType()) for c in ("pos", "pos_n", "neg", "neg_n")]
    out = [T.StructField("pos", T.LongType()), T.StructField("neg", T.LongType()), T.StructField("twice_u", T.DecimalType(38, 0))]

    def pack(batches):
        import pyarrow as pa

        held, n = [], 0

        def flush():
            columns = _chunks(pa.Table.from_batches(held), len(by), n_scores, edges)
            return pa.RecordBatch.from_arrays(columns, names=[f.name for f in (*kinds, *places, *packed)])

        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n * n_scores >= AT_ONCE:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    def merge(table):
        from decimal import Decimal

        import pyarrow as pa

        p, n, u = _merged([table.column(f.name) for f in packed])
        sums = [pa.array([p]), pa.array([n]), pa.array([Decimal(u)], pa.decimal128(38, 0))]
        return pa.Table.from_arrays([table.column(f.name).slice(0, 1).combine_chunks() for f in (*kinds, *places)] + sums, names=[f.name for f in (*kinds, *places, *out)])

    chunks = rows.mapInArrow(pack, T.StructType([*kinds, *places, *packed]))
    merged = chunks.groupBy(*by, "_place", "_range").applyInArrow(merge, T.StructType([*kinds, *places, *out]))
    variant = Window.partitionBy(*by, "_place")  # as many rows as ranges
    before = F.coalesce(F.sum("neg").over(variant.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = F.sum(F.col("twice_u") + F.lit(2) * F.col("pos").cast("decimal(19,0)") * F.col("_below").cast("decimal(18,0)"))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    figure = F.when(pairs > 0, won.cast("double") / (F.lit(2.0) * pairs))
    called = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_place") + 1).alias(name)
    return merged.withColumn("_below", before).groupBy(*by, "_place").agg(figure.alias("roc_auc")).select(*by, called, "roc_auc")
