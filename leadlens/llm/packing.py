"""Vector bin packing of token sequences.

Every example has a demand in three dimensions: tokens, segments (one per piece) and loss-bearing
tokens.  A sequence is a bin with a limit in each.  The open bin takes, again and again, the example with
the largest dot product of its demand and the bin's free room, weighted by the mean demand of the waiting
examples; if none fits whole, one example is cut so that the bin is filled.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.llm.common import text_of, tidied
from leadlens.llm.encoding import PieceEncoder


class VectorPacker:
    """Packs one stream of examples; holds at most ``pool`` waiting pieces shorter than a sequence."""

    def __init__(self, limit: int, max_segments: int, max_loss: int, pool: int = 2048, first_sequence: int = 0):
        import numpy as np

        if limit < 1 or limit & (limit - 1) or max_segments < 1 or max_loss < 1:
            raise ValueError("limit must be a power of two; the other limits at least 1")
        self.limit, self.max_segments, self.max_loss, self.pool, self.next = limit, max_segments, max_loss, pool, first_sequence
        self.np = np
        self.items: list[tuple] = []  # (key, start, n, n without loss at its head)

    def add(self, key, n: int, quiet: int) -> Iterator[tuple]:
        """An example of ``n`` tokens, the first ``quiet`` of which bear no loss.  Yields finished pieces:
        (key, start, length, loss tokens, sequence, offset, sequence length)."""
        start = 0
        while n - start >= self.limit and min(self.limit, max(0, start + self.limit - max(quiet, start))) <= self.max_loss:
            loss = max(0, start + self.limit - max(quiet, start))
            yield key, start, self.limit, loss, self.next, 0, self.limit
            self.next += 1
            start += self.limit
        while n > start:
            take = self._room(start, n - start, quiet, self.limit, self.max_loss)
            self.items.append((key, start, take, max(0, min(take, quiet - start))))
            start += take
        if len(self.items) >= self.pool:
            yield from self._pack(self.pool // 2)

    @staticmethod
    def _room(start: int, n: int, quiet: int, tokens: int, loss: int) -> int:
        """Longest head of ``n`` tokens with at most so many tokens and loss-bearing tokens."""
        return min(n, tokens, max(0, quiet - start) + loss)

    def finish(self) -> Iterator[tuple]:
        yield from self._pack(0)

    def _pack(self, leave: int) -> Iterator[tuple]:
        """Fills bins until at most ``leave`` pieces wait.  With ``leave`` 0 the last bins, which the rest can't
        fill, are powers of two, so that they need no padding."""
        np = self.np
        n = np.array([i[2] for i in self.items], np.int64)
        quiet = np.array([i[3] for i in self.items], np.int64)
        items = list(self.items)
        while items and (leave == 0 or len(items) > leave):
            # the waiting pieces alone, by their order
            loss, alive, waiting = n - quiet, np.ones(len(n), bool), int(n.sum())
            cap = self.limit if waiting >= self.limit else 1 << (waiting.bit_length() - 1)
            weight = (float(n.mean()) / self.limit, 1 / self.max_segments, float(loss.mean()) / self.max_loss)
            room, segments, room_loss = cap, self.max_segments, self.max_loss
            offset, placed = 0, []
            while room > 0 and segments > 0:
                fits = np.flatnonzero(alive & (n <= room) & (loss <= room_loss))
                if len(fits):
                    free = weight[0] * room / self.limit, weight[1] * segments / self.max_segments, weight[2] * room_loss / self.max_loss
                    gain = free[0] * n[fits] / self.limit + free[1] / self.max_segments + free[2] * loss[fits] / self.max_loss
                    k = int(fits[gain.argmax()])
                    take = int(n[k])
                else:
                    head = np.where(alive, np.minimum(np.minimum(n, room), quiet + room_loss), 0)
                    k = int(head.argmax())
                    take = int(head[k])
                    if take == 0:
                        break
                key, start, size, still = items[k]
                bears = take - min(take, still)
                placed.append((key, start, take, bears, offset))
                offset += take
                room, segments, room_loss = room - take, segments - 1, room_loss - bears
                if take == size:
                    alive[k] = False
                else:
                    items[k] = (key, start + take, size - take, max(0, still - take))
                    n[k], quiet[k] = size - take, max(0, still - take)
                    loss[k] = n[k] - quiet[k]
            whole = offset if offset & (offset - 1) == 0 else self.limit
            for key, start, take, bears, at in placed:
                yield key, start, take, bears, self.next, at, whole
            self.next += 1
            left = np.flatnonzero(alive)
            items, n, quiet = [items[k] for k in left], n[left], quiet[left]
        self.items = items


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    seq_len: int = 2048,
    max_segments: int = 256,
    max_loss_tokens: int | None = None,
    prompt_col: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    remember: int = 800_000,
) -> DataFrame:
    """Packs every row's tokens (text, then ``end_id``) into sequences; one output row per piece.

    With ``prompt_col``, the prompt's tokens come first and bear no loss.  Sequences are formed within a
    task's rows, without a shuffle: their number and filling depend on the split of the input, their
    content never crosses tasks, and a lost task is run again alone with the same result.  A task holds one Arrow
    batch and a bounded pool of pieces.  A null text or prompt is empty (the text has its end id alone);
    ``remember`` words keep their ids in a task (some 230 bytes each), which the result doesn't depend on;
    null, repeated ids and repeated rows are packed like any other row; an empty table gives no row; other
    columns are ignored.

    Columns: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset,
    loss_tokens, sequence_length (``seq_len`` with padding, or the power of two it fills exactly).
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("loss_tokens", T.LongType()),
            T.StructField("sequence_length", T.LongType()),
        ]
    )
    limit_loss = max_loss_tokens or seq_len
    names = [f.name for f in schema]

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = PieceEncoder(tokenizer_path, end_id, remember, added=True)
        packer = VectorPacker(seq_len, max_segments, limit_loss, first_sequence=TaskContext.get().partitionId() << 40)
        held: dict[int, list] = {}  # row -> [id, ids, tokens left]
        out_schema = None
        row = 0

        def rows(pieces):
            for key, start, take, loss, seq, at, whole in pieces:
                doc = held[key]
                ids = doc[1]
                yield doc[0], start, take, ids[4 * start : 4 * (start + take)], len(ids) // 4, seq, at, loss, whole
                doc[2] -= take
                if not doc[2]:
                    del held[key]

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), out_schema)], names=names)

        out: list[tuple] = []
        for b in batches:
            if out_schema is None:
                types = {"start": pa.int64(), "length": pa.int64(), "ids": pa.binary()}
                out_schema = pa.schema([("doc_id", b.schema.field(0).type)] + [(c, types.get(c, pa.int64())) for c in names[1:]])
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                keys, prompts, texts = part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()
                for key, prompt, ids in zip(keys, prompts, encoder.encode(texts)):
                    head = encoder.encode([prompt])[0][:-4] if prompt else b""
                    held[row] = [key, head + ids, len(head + ids) // 4]
                    out.extend(rows(packer.add(row, len(head + ids) // 4, len(head) // 4)))
                    row += 1
                if len(out) >= 512:
                    yield batch(out)
                    out = []
        out.extend(rows(packer.finish()))
        for lo in range(0, len(out), 512):
            yield batch(out[lo : lo + 512])

    prompt = text_of(prompt_col) if prompt_col else F.lit("")
    return docs.select(F.col(id_col).alias("doc_id"), prompt.alias("prompt"), text_of(text_col).alias("text")).mapInArrow(tidied(run), schema)
