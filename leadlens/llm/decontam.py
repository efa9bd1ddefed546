"""Benchmark decontamination: approximate occurrences of benchmark passages in documents, by the q-gram lemma.

A passage of m characters that occurs with at most k edits shares at least m + 1 - q (k + 1) q-grams with
that region, on diagonals at most k apart.  Shared q-grams are counted in overlapping diagonal bands; bands that meet
the bound are verified by banded alignment.  q is 8, but 4 for passages too short for the lemma with 8 and their budget; passages of
under 4 characters, which have no budget, are searched word for word.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from leadlens.llm.common import text_of, tidied, union_all

#: Characters of passages that go to the executors at once (some 30 bytes each); more are done in further passes.
MOST_CHARS = 4_000_000
Q, SHORT_Q, RATE = 8, 4, 0.1


def _normal(text: str) -> str:
    """Lower case, white space runs as one blank."""
    return " ".join(text.lower().split())


def _codes(text: str):
    import numpy as np

    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _grams(codes, q: int = Q):
    """64-bit hashes of all q-grams (q a power of two) by doublings."""
    import numpy as np

    h = codes.astype(np.uint64) + np.uint64(1)
    base = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for half in (1 << b for b in range(q.bit_length() - 1)):
            h = h[:-half] * base + h[half:]
            base = base * base
        h ^= h >> np.uint64(29)
        return h * np.uint64(0xBF58476D1CE4E5B9)


def align(pattern, text, lo: int, width: int) -> tuple[int, int]:
    """(edits, end) of the best occurrence of ``pattern`` in ``text`` among paths whose diagonals (text position less pattern
    position) are lo to lo + width - 1; the start is free; ends prefer the earliest.  Code arrays."""
    import numpy as np

    m, n = len(pattern), len(text)
    big, off = 1 << 20, np.arange(width)
    at = lo + off  # text characters used before row 0
    row = np.where((at >= 0) & (at <= n), 0, big)
    padded = np.concatenate([np.full(width + m + 1, 0xFFFFFFFF, np.uint32), text, np.full(width + m + 1, 0xFFFFFFFF, np.uint32)])
    shift = width + m + 1
    for i in range(m):
        j = lo + i  # text index that band position 0 takes in this row
        window = padded[shift + j : shift + j + width] if 0 <= shift + j <= len(padded) - width else np.full(width, 0xFFFFFFFF, np.uint32)
        here = row + (window != pattern[i])
        here[:-1] = np.minimum(here[:-1], row[1:] + 1)
        ends = j + 1 + off
        here[(ends < 0) | (ends > n)] = big
        here = np.minimum.accumulate(here - off) + off
        here[(ends < 0) | (ends > n)] = big
        row = here
    best = int(row.argmin())
    return int(row[best]), lo + m + best


def budget(length: int, rate: float) -> int:
    """Edits that a passage may have."""
    return int(rate * length)


def _distinct(columns: list):
    """Distinct rows of non-negative integers, sorted, as one column each; sorted as one number where the numbers fit in one."""
    import numpy as np

    sizes = [int(c.max()) + 1 for c in columns]
    if math.prod(sizes) >= 1 << 62:
        return np.unique(np.stack(columns), axis=1)
    packed = columns[0].astype(np.int64)
    for c, n in zip(columns[1:], sizes[1:]):
        packed = packed * n + c
    packed.sort()
    packed = packed[np.append(True, packed[1:] != packed[:-1])]
    out = []
    for n in reversed(sizes[1:]):
        packed, rest = np.divmod(packed, n)
        out.append(rest)
    return np.stack([packed, *reversed(out)])


class Scanner:
    """Finds the passages (id, text) in texts: every region with at most ``rate`` edits a character, but of overlapping ones the best alone.
    Empty passages never match."""

    def __init__(self, passages: list[tuple], rate: float = RATE):
        sets: dict[int, list] = {Q: [], SHORT_Q: []}
        self.tiny = []
        for key, text in passages:
            normal = _normal(text)
            k = budget(len(normal), rate)
            if len(normal) >= Q * (k + 1):  # the lemma promises a gram
                sets[Q].append((key, normal, k))
            elif len(normal) >= SHORT_Q * (k + 1):
                sets[SHORT_Q].append((key, normal, k))
            elif normal:
                if k:
                    raise ValueError(f"{k} edits in {len(normal)} characters: the rate is too high for the q-gram lemma")
                self.tiny.append((key, normal))
        self.parts = [Part(some, q) for q, some in sets.items() if some]

    def find(self, texts: list[str], window: int = 1 << 20) -> list[list[tuple]]:
        """Of each text its matches (item, start, end, edits, passage length) in normalised characters.  Texts over ``window`` characters are
        searched in overlapping windows."""
        normal = [_normal(t) for t in texts]
        codes = [_codes(t) for t in normal]
        out: list[list[tuple]] = [[] for _ in texts]
        for part in self.parts:
            for got, found in zip(out, part.find(codes, window)):
                got += found
        for key, passage in self.tiny:
            for got, text in zip(out, normal):
                at = text.find(passage)
                while at >= 0:
                    got.append((key, at, at + len(passage), 0, len(passage)))
                    at = text.find(passage, at + len(passage))
        return out


class Part:
    """The search for passages (id, normalised text, edits) by one gram length."""

    def __init__(self, passages: list[tuple], q: int):
        import numpy as np

        self.q, self.items = q, []
        grams, owner, place = [], [], []
        for key, text, k in passages:
            codes = _codes(text)
            g = _grams(codes, q)
            grams.append(g)
            owner.append(np.full(len(g), len(self.items)))
            place.append(np.arange(len(g)))
            self.items.append((key, codes, k, len(codes) + 1 - q * (k + 1)))
        g = np.concatenate(grams)
        order = np.argsort(g, kind="stable")
        self.grams, self.first = np.unique(g[order], return_index=True)
        self.last = np.append(self.first[1:], len(g))
        self.owner, self.place = np.concatenate(owner)[order], np.concatenate(place)[order]
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.grams >> np.uint64(44)).astype(np.int64)] = True
        self.need = np.array([i[3] for i in self.items])
        self.band = np.array([2 * i[2] + 1 for i in self.items])
        self.longest = max(len(i[1]) for i in self.items)

    def find(self, texts: list, window: int) -> list[list[tuple]]:
        out: list[dict] = [{} for _ in texts]
        pieces, total = [], 0
        lap = 4 * self.longest + 64
        for t, codes in enumerate(texts):
            step = max(window - lap, lap)
            for lo in range(0, max(1, len(codes) - lap), step):
                pieces.append((t, lo, codes[lo : lo + step + lap]))
                total += len(pieces[-1][2])
                if total > window:
                    self._search(pieces, out)
                    pieces, total = [], 0
        self._search(pieces, out)
        return [[(self.items[p][0], s, e, d, len(self.items[p][1])) for p, found in sorted(of.items()) for d, s, e in apart(found)] for of in out]

    def _search(self, pieces: list[tuple], out: list[dict]) -> None:
        import numpy as np

        pieces = [p for p in pieces if len(p[2]) >= self.q]
        if not pieces:
            return
        starts = np.cumsum([0] + [len(p[2]) for p in pieces])
        text = np.concatenate([p[2] for p in pieces])
        g = _grams(text, self.q)
        at = np.flatnonzero(self.bits[(g >> np.uint64(44)).astype(np.int64)])
        k = np.searchsorted(self.grams, g[at])
        k[k == len(self.grams)] = 0
        same = self.grams[k] == g[at]
        at, k = at[same], k[same]
        piece = np.searchsorted(starts, at, "right") - 1
        inside = at + self.q <= starts[piece + 1]
        at, k, piece = at[inside], k[inside], piece[inside]
        count = self.last[k] - self.first[k]
        pick = np.repeat(self.first[k] - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(k) else k, count) + np.arange(count.sum())
        item, j = self.owner[pick], self.place[pick]
        at, piece = np.repeat(at, count), np.repeat(piece, count)
        bin_ = (at - starts[piece] - j + self.longest) // self.band[item]
        # distinct places of the passage in each (piece, passage, bin)
        key = _distinct([piece, item, bin_, j]) if len(item) else np.empty((4, 0), np.int64)
        if not key.shape[1]:
            return
        edge = np.concatenate([[0], np.flatnonzero((key[:3, 1:] != key[:3, :-1]).any(axis=0)) + 1, [key.shape[1]]])
        piece, item, bin_, n = key[0, edge[:-1]], key[1, edge[:-1]], key[2, edge[:-1]], np.diff(edge)
        follows = np.zeros(len(n), np.int64)
        next_ = (piece[1:] == piece[:-1]) & (item[1:] == item[:-1]) & (bin_[1:] == bin_[:-1] + 1)
        follows[:-1][next_] = n[1:][next_]
        # the band of bins b - 1 and b matters where b - 1 is empty, too: it is then no fuller than b and b + 1
        for x in np.flatnonzero(n + follows >= self.need[item]).tolist():
            t, lo, codes = pieces[piece[x]]
            p = int(item[x])
            _, pattern, k_edits, _ = self.items[p]
            w = int(self.band[p])
            left, width = int(bin_[x]) * w - self.longest - k_edits, 2 * (w + k_edits) + 1
            edits, end = align(pattern, codes, left, width)
            if edits > k_edits:
                continue
            back, length = align(pattern[::-1], codes[max(0, end - len(pattern) - k_edits) : end][::-1], -k_edits, 2 * k_edits + 1) if edits else (0, len(pattern))
            begin = end - (length if back == edits else len(pattern))
            out[t].setdefault(p, []).append((edits, lo + begin, lo + end))


def apart(found: list[tuple]) -> list[tuple]:
    """Of (edits, start, end) regions those that overlap no better one (fewer edits, then the earlier), by start."""
    kept: list[tuple] = []
    for d, s, e in sorted(set(found)):
        if all(e <= x or s >= y for _, x, y in kept):
            kept.append((d, s, e))
    return sorted(kept, key=lambda r: r[1])


def passage_sets(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> list[list[tuple]]:
    """The passages in sets of at most MOST_CHARS characters (one longer passage makes its own set).  Null passages are left out;
    a null id is kept."""
    rows = benchmark.filter(F.col(text_col).isNotNull()).select(item_col, text_col).distinct()
    total = rows.agg(F.sum(F.length(text_col))).first()[0] or 0
    n = -(-total // MOST_CHARS) or 1
    if n == 1:
        return [[tuple(r) for r in rows.collect()]]
    return [[tuple(r) for r in rows.filter(F.pmod(F.xxhash64(item_col, text_col), F.lit(n)) == i).collect()] for i in range(n)]


def _per_text(passages: list[tuple], rate: float) -> Callable:
    made = []

    def find(texts: list[str]) -> list[list[tuple]]:
        if not made:
            made.append(Scanner(passages, rate))
        return made[0].find(texts)

    return find


def find_passages(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and region of a passage that occurs in it with at most ``rate`` edits a character: doc_id, item_id, start, end
    (characters of the text in lower case with single blanks), edits, passage_length.

    Regions of one passage don't overlap: a better one (fewer edits, then the earlier) displaces those it overlaps.  Null and empty texts
    have no row; repeated rows have a row each; an empty table, or benchmark, gives none; null and empty passages never match; other columns
    are ignored.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("item_id", benchmark.schema[item_col].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("start", "end", "edits", "passage_length")]
    )
    types, names = [to_arrow_type(f.dataType) for f in schema], [f.name for f in schema]

    def one(passages: list[tuple]) -> DataFrame:
        find = _per_text(passages, rate)

        def run(batches):
            import pyarrow as pa

            for b in batches:
                for lo in range(0, b.num_rows, 256):
                    part = b.slice(lo, 256)
                    rows = [(d, *x) for d, got in zip(part.column(0).to_pylist(), find(part.column(1).to_pylist())) for x in got]
                    if rows:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(tidied(run), schema)

    return union_all([one(p) for p in passage_sets(benchmark, item_col, item_text)])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows in whose text a passage occurs; the rest passes unchanged, without a shuffle.

    Rows with a null or empty text stay; equal rows stay or go alike; an empty table stays empty, and with an empty benchmark all rows stay."""
    place = docs.columns.index(text_col)

    def one(frame: DataFrame, passages: list[tuple]) -> DataFrame:
        find = _per_text(passages, rate)

        def run(batches):
            import pyarrow as pa

            for b in batches:
                for lo in range(0, b.num_rows, 256):
                    part = b.slice(lo, 256)
                    clean = [not got for got in find([t or "" for t in part.column(place).to_pylist()])]
                    yield part.filter(pa.array(clean, pa.bool_()))

        return frame.mapInArrow(tidied(run), frame.schema)

    for p in passage_sets(benchmark, item_col, item_text):
        docs = one(docs, p)
    return docs
