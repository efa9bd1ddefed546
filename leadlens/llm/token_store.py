"""Token ids in Arrow files of fixed-size-list batches: equal-length sequences and masks with random access.

A store is a folder of ``shard-<n>.arrow`` (Arrow IPC file format: a footer locates every batch, so a memory-mapped
reader slices any sequence without a copy) and ``index`` (Parquet: one row per document).  A shard holds
the ids of a range of documents in ascending id order, one after the other; only its last sequence is padded,
where the mask is false.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.llm.common import text_of, tidied
from leadlens.llm.encoding import PieceEncoder


def _filesystem(path: str):
    """(Arrow file system, path in it) of a local path or a URI that Arrow knows (file, hdfs, s3, gs)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_token_store(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    seq_len: int = 2048,
    batch_rows: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
) -> None:
    """Encodes every whole text, ends it with ``end_id`` and writes the store to ``path`` (shared storage).

    Documents are dealt to shards by ranges of (id, text hash), so a repeated id is split too; within a shard they
    stand by id, then text (nulls first).  Null texts are empty and still have their end id.  A shard is written under a name of
    its attempt and then renamed, so a task that runs again leaves the same file.  An empty table
    gives an index without rows and no shard.  Other columns are ignored.
    """
    kind = docs.schema[id_col].dataType
    index = T.StructType(
        [T.StructField("doc_id", kind), T.StructField("shard", T.IntegerType()), T.StructField("local", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        encoder = PieceEncoder(tokenizer_path, end_id, added=True)
        small = encoder.tok.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
        ids_type, np_type = (pa.uint16(), np.uint16) if small else (pa.uint32(), np.uint32)
        schema = pa.schema([("ids", pa.list_(ids_type, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        store, base = _filesystem(path)
        shard, sink, writer, at = task.partitionId(), None, None, 0
        name, tmp = f"{base}/shard-{shard:06d}.arrow", f"{base}/.shard-{shard:06d}-{task.taskAttemptId()}"
        waiting, n_waiting = [], 0

        def put(last: bool):
            nonlocal waiting, n_waiting
            ids = np.concatenate(waiting) if waiting else np.empty(0, np_type)
            step = seq_len * batch_rows
            end = len(ids) if last else len(ids) // step * step
            for lo in range(0, end, step):
                part = ids[lo : min(lo + step, end)]
                rows = -(-len(part) // seq_len)
                full = np.zeros(rows * seq_len, np_type)
                full[: len(part)] = part
                mask = np.arange(rows * seq_len) < len(part)
                writer.write_batch(
                    pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(full), seq_len), pa.FixedSizeListArray.from_arrays(pa.array(mask), seq_len)], schema=schema)
                )
            waiting, n_waiting = ([ids[end:]], len(ids) - end) if end < len(ids) else ([], 0)

        for b in batches:
            if writer is None and b.num_rows:
                sink = store.open_output_stream(tmp)
                writer = pa.ipc.new_file(sink, schema)
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                lengths, starts = [], []
                for ids in encoder.encode(part.column(1).to_pylist()):
                    starts.append(at)
                    lengths.append(len(ids) // 4)
                    at += len(ids) // 4
                    waiting.append(np.frombuffer(ids, "<u4").astype(np_type))
                    n_waiting += len(ids) // 4
                    if n_waiting >= 16 * seq_len * batch_rows:
                        put(False)
                yield pa.record_batch(
                    [part.column(0), pa.array([shard] * len(starts), pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["doc_id", "shard", "local", "n_tokens"],
                )
        if writer is not None:
            put(True)
            writer.close()
            sink.close()
            store.move(tmp, name)

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    store, base = _filesystem(path)
    store.create_dir(base)
    dealt = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    dealt.mapInArrow(tidied(run), index).write.parquet(f"{path}/index")


def read_token_store(spark: SparkSession, path: str) -> DataFrame:
    """Reads every document back from the shards: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian
    unsigned 32-bit).  Starts add the shards' totals, one number per file."""
    index = spark.read.parquet(f"{path}/index")
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    schema = T.StructType(
        [index.schema["doc_id"], T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    )

    def run(batches):
        import numpy as np
        import pyarrow as pa

        store, base = _filesystem(path)
        shard, reader, length, per = None, None, 0, 0
        cache: dict[int, tuple] = {}

        def opened(k: int):
            f = f"{base}/shard-{k:06d}.arrow"
            return pa.ipc.open_file(pa.memory_map(f) if store.type_name == "local" else store.open_input_file(f))

        def piece(lo: int, n: int):
            """Ids lo to lo+n of the open shard, from the batches that hold them."""
            parts = []
            while n > 0:
                k, at = divmod(lo, length * per)
                if k not in cache:
                    cache.clear()
                    b = reader.get_batch(k)
                    # .values of a fixed-size list is the mapped buffer itself
                    cache[k] = b.column(0).values.to_numpy(zero_copy_only=True), b.column(1).values
                ids, mask = cache[k]
                got = ids[at : at + n]
                if not len(got) or mask.slice(at, len(got)).true_count != len(got):
                    raise ValueError(f"shard {shard} has padding or an end at id {lo}")
                parts.append(got)
                lo += len(got)
                n -= len(got)
            return np.concatenate(parts) if len(parts) > 1 else parts[0]

        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ids, counts = [], []
                for k, local, n in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), part.column(4).to_pylist()):
                    if k != shard:
                        shard, reader = k, opened(k)
                        cache.clear()
                        first = reader.get_batch(0)
                        length, per = first.schema.field(0).type.list_size, first.num_rows
                    got = piece(local, n)
                    ids.append(got.astype("<u4").tobytes())
                    counts.append(len(got))
                yield pa.record_batch([part.column(0), part.column(1), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    placed = index.join(F.broadcast(before), "shard").select("doc_id", (F.col("before") + F.col("local")).alias("start"), "shard", "local", "n_tokens")
    return placed.mapInArrow(tidied(run), schema)
