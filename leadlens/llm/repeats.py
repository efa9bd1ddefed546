"""Repeated byte strings, by suffixes sorted deep and shallow.

A byte goes if a string of ``length`` bytes that covers it also starts earlier in the corpus (in a document of smaller id, or
earlier in its own).  Not every suffix is sorted: of all grams (``GRAM`` bytes) in a window of ``length`` bytes, the one of least hash
is its anchor, at the same place in equal windows.  Only anchors whose gram occurs elsewhere too are looked at, with the bytes
that any window around them can hold: the suffix from the anchor on, and the reversed prefix before it.

Both are sorted within groups of equal anchors: multikey quicksort (words of eight bytes as keys) to a shallow depth, then
blind tries for the groups that still share all of it.  With the longest common prefixes of sorted neighbours, two anchors hold the same
window that starts d bytes before them if their prefixes agree on d bytes and their suffixes on ``length`` - d.

Copies of a text are set aside first, as they go whole.  Equal surroundings of anchors are collapsed in each task before the
shuffle.  A group of still more than ``most`` anchors is not held in memory: its windows travel alone, as digests, and are
compared with their neighbour in sorted order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import free_name, text_of, tidied, written

#: Bytes of an anchor.
GRAM = 40
#: Bytes that are hashed at once.
PIECE = 1 << 20
#: Sets of more copies than one in this many texts are dropped by broadcast, so that at most this many rows are.
HOT = 5000


def gram_anchors(data, ends: list[int], length: int, gram: int):
    """(places, hashes) of the anchors of all windows of ``length`` bytes in ``data`` that cross none of ``ends``."""
    import numpy as np

    n = len(data)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    factor = np.full(n + 1, 0x9E3779B97F4A7C15, np.uint64)
    factor[0] = 1
    power = np.cumprod(factor)
    factor[1:] = pow(0x9E3779B97F4A7C15, -1, 1 << 64)
    inverse = np.cumprod(factor)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + 1) * power[:-1])])
    h = (total[gram:] - total[:-gram]) * inverse[: n - gram + 1]
    h ^= h >> 32
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> 32

    def slide(x, width, best):
        """best of every ``width`` neighbours"""
        done = 1
        while done < width:
            step = min(done, width - done)
            x = best(x[:-step], x[step:])
            done += step
        return x

    width = length - gram + 1
    least = slide(h, width, np.minimum)  # by window start
    for e in ends:
        least[max(0, e - length + 1) : e] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    top = slide(padded, width, np.maximum)  # by gram: the greatest least of the windows that hold it
    at = np.flatnonzero((top == h) & (top > 0))
    return at, h[at]


def _lcp(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (x.bit_length() + 7) // 8


def shallow_sort(keys, limit: int):
    """(order, first, depth): multikey quicksort of rows of words down to ``limit`` words, all open segments in step.

    ``first`` marks where segments start in the order; the rows of a segment agree on ``depth`` words.
    """
    import numpy as np

    n = len(keys)
    order, first, depth = np.arange(n), np.zeros(n, bool), np.zeros(n, np.int64)
    first[:1] = True
    while True:
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, n))
        live = (sizes > 1) & (depth[starts] < limit)
        if not live.any():
            return order, first, depth
        starts, sizes = starts[live], sizes[live]
        seg = np.repeat(np.arange(len(starts)), sizes)
        lead = np.cumsum(sizes) - sizes
        pos = np.arange(len(seg)) - lead[seg] + starts[seg]
        word = keys[order[pos], depth[pos]]
        pivot = word[lead + sizes // 2][seg]
        side = 3 * seg + 1 + (word > pivot) - (word < pivot)
        moved = np.argsort(side, kind="stable")
        order[pos] = order[pos[moved]]
        side = side[moved]
        first[pos] = np.append(True, side[1:] != side[:-1])
        depth[pos] += side % 3 == 1


def blind_trie(rows: list[int], text: list[bytes]) -> list[tuple[int, int]]:
    """``rows`` sorted by their texts, each with its longest common prefix with the row before.

    Inner nodes hold a depth and branches by the byte there (-1: the end), leaves the rows of one text.  A new text goes down by the bytes
    at the nodes alone, on any branch where its own is missing, is compared once, with the leaf it comes to, and is put in where the two part.
    """
    root: list = [None, [rows[0]]]  # leaf: [None, rows]; node: [depth, branches]
    for r in rows[1:]:
        s = text[r]
        path, node = [], root
        while node[0] is not None:
            path.append(node)
            c = s[node[0]] if node[0] < len(s) else -1
            below = node[1].get(c)
            node = below if below is not None else next(iter(node[1].values()))
        t = text[node[1][0]]
        if s == t:
            node[1].append(r)
            continue
        d = _lcp(s, t)
        while path and path[-1][0] >= d:
            node = path.pop()
        mine = s[d] if d < len(s) else -1
        if node[0] == d:
            node[1][mine] = [None, [r]]
            continue
        split = [d, {t[d] if d < len(t) else -1: node, mine: [None, [r]]}]
        if path:
            up = path[-1]
            up[1][s[up[0]] if up[0] < len(s) else -1] = split
        else:
            root = split
    out: list[tuple[int, int]] = []
    stack = [(root, 0)]
    while stack:
        node, shared = stack.pop()
        if node[0] is None:
            n = len(text[node[1][0]])
            out += [(r, shared if i == 0 else n) for i, r in enumerate(node[1])]
        else:
            for i, (_, below) in reversed(list(enumerate(sorted(node[1].items())))):
                stack.append((below, shared if i == 0 else node[0]))
    return out


def deep_shallow_sort(text: list[bytes], width: int, shallow: int):
    """(order, lcp) of ``text`` (at most ``width`` bytes each): lcp[i] is shared by places i - 1 and i of the order, lcp[0] is 0."""
    import numpy as np

    n, words = len(text), -(-width // 8)
    size = np.fromiter(map(len, text), np.int64, n)
    table = np.frombuffer(b"".join(t.ljust(8 * words, b"\0") for t in text), np.uint8).reshape(n, 8 * words)
    order, first, _ = shallow_sort(table.view(">u8").astype(np.uint64), min(shallow // 8, words))
    lcp = np.zeros(n, np.int64)
    starts = np.flatnonzero(first)
    for a, b in zip(starts.tolist(), np.append(starts[1:], n).tolist()):
        if b - a > 1:
            got = blind_trie(order[a:b].tolist(), text)
            order[a:b] = [r for r, _ in got]
            lcp[a:b] = [d for _, d in got]
    cut = starts[starts > 0]
    differ = table[order[cut - 1]] != table[order[cut]]
    lcp[cut] = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), 8 * words), np.minimum(size[order[cut - 1]], size[order[cut]]))
    return order, lcp


def repeated_windows(before: list[bytes], after: list[bytes], length: int, gram: int):
    """(least, most) per row: the window starts, in bytes before the anchor, whose strings an earlier row has too (-1: none).

    ``before`` holds the reversed bytes before an anchor, ``after`` those from it on.
    """
    import numpy as np

    n, reach = len(after), length - gram
    least, most = np.full(n, -1), np.full(n, -1)
    if n < 2:
        return least, most
    shallow = -(-gram // 8) * 8 + 24
    a_order, a_lcp = deep_shallow_sort(after, length, shallow)
    b_order, b_lcp = deep_shallow_sort(before, reach, 32)
    a_of, b_of = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(reach + 1):
        a_of[a_order] = np.cumsum(a_lcp < length - d)
        b_of[b_order] = np.cumsum(b_lcp < d) if d else 0
        both = b_of * (n + 1) + a_of
        rank = np.argsort(both, kind="stable")
        again = rank[1:][both[rank][1:] == both[rank][:-1]]
        most[again] = d
        least[again] = np.where(least[again] < 0, d, least[again])
    return least, most


def _copies(docs: DataFrame, id_col: str, text_col: str, length: int) -> tuple[DataFrame, DataFrame]:
    """(copies, texts): rows (doc, doc_id, n, n_bytes, whole) of equal rows, and (k, doc, first, body) of the distinct texts that hold a window.

    doc is the text's MD5, k a hash of it by which texts are dealt, first the smallest id of the copies (null last).
    """
    body = text_of(text_col).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("body")).withColumn("doc", F.unhex(F.md5("body")))
    whole = F.when(F.length("body") < length, F.sha2("body", 256)).alias("whole")
    copies = written(rows.groupBy("doc", "doc_id", F.length("body").cast("long").alias("n_bytes"), whole).agg(F.count("*").alias("n")), "copies")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("f")
    many = copies.filter(F.col("n_bytes") >= length).groupBy("doc").agg(first, F.sum("n").alias("n"))
    total = copies.agg(F.sum("n")).first()[0] or 0
    hot = many.filter(F.col("n") > max(total / HOT, 1)).select("doc", F.col("f.doc_id").alias("stays"), F.lit(True).alias("hot"))
    long = rows.filter(F.length("body") >= length).join(F.broadcast(hot), "doc", "left").filter("hot is null or doc_id <=> stays")
    dealt = long.select(F.xxhash64("doc").alias("k"), "doc", "doc_id", "body").repartition("k")
    texts = dealt.groupBy("k", "doc").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("f"), F.first("body").alias("body"))
    return copies, texts.select("k", "doc", F.col("f.doc_id").alias("first"), "body")


def _anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, k, pos) of all anchors; some stand twice where a long text is hashed in pieces.

    A gram that occurs again in its own piece is known to be shared: one of its rows goes on under h, and all as -1 - pos under a
    hash of their place, so that a very common gram isn't dealt to one task.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            body = b.column(3)
            at = np.frombuffer(body.buffers()[1], np.int32 if pa.types.is_binary(body.type) else np.int64)[body.offset : body.offset + len(body) + 1].astype(np.int64)
            data = np.frombuffer(body.buffers()[2], np.uint8) if body.buffers()[2] else np.zeros(0, np.uint8)
            keys = b.column(0).to_numpy(zero_copy_only=False)
            lo, last = int(at[0]) if len(at) else 0, int(at[-1]) if len(at) else 0
            while lo < last:
                hi = min(lo + PIECE, last)
                inside = at[np.searchsorted(at, lo, "right") : np.searchsorted(at, hi, "left")]
                place, h = gram_anchors(data[lo:hi], (inside - lo).tolist(), length, gram)
                row = np.searchsorted(at, place + lo, "right") - 1
                k, pos = keys[row], place + lo - at[row]
                _, one, of, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                known = count[of] > 1
                spread = (k[known].view(np.uint64) + pos[known].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                cols = [np.append(h[one], spread).view(np.int64), np.append(k[one], k[known]), np.append(pos[one], -1 - pos[known])]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["h", "k", "pos"])
                lo = hi - length + 1 if hi < last else last

    return texts.mapInArrow(tidied(run), "h long, k long, pos long")


def _shared(anchors: DataFrame) -> DataFrame:
    """(k, pos) of the anchors whose gram occurs more than once."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, shared = None, None  # a row that may stand alone; the last gram that doesn't
        for b in batches:
            h, k, pos = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(h):
                continue
            known = pos < 0
            free = ~known
            out = [np.stack([k[known], -1 - pos[known]])]
            h, k, pos = h[free], k[free], pos[free]
            if held is not None:
                h, k, pos = (np.append(x, y) for x, y in zip(held, (h, k, pos)))
            if len(h):
                same = h[1:] == h[:-1]
                keep = np.append(False, same) | np.append(same, False) | (h == shared if shared is not None else False)
                last = bool(keep[-1])
                held = None if last else (h[-1:], k[-1:], pos[-1:])
                shared = h[-1] if last else None
                out.append(np.stack([k[keep], pos[keep]]))
            both = np.concatenate(out, axis=1)
            yield pa.record_batch([pa.array(both[0]), pa.array(both[1])], names=["k", "pos"])

    return anchors.repartition("h").sortWithinPartitions("h").mapInArrow(tidied(run), "k long, pos long")


def _surroundings(texts: DataFrame, shared: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows of shared anchors, with the reversed bytes before and those from it on, and of spans that are known to be repeated, with
    start and stop (before and after null)."""
    reach = length - gram
    places = shared.groupBy("k").agg(F.collect_set("pos").alias("places"))
    names = ["first", "doc", "start", "stop", "before", "after"]

    def run(batches):
        import pyarrow as pa

        types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

        def rows(out):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types)], names=names)

        seen: dict = {}  # surroundings: their earliest place in this task
        out: list = []

        def flush():
            out.extend((None if none else first, doc, pos, None, *around) for around, (none, first, doc, pos) in seen.items())
            seen.clear()

        for b in batches:
            docs, firsts = b.column(1).to_pylist(), b.column(2).to_pylist()
            # in the documents' order, so that the later of two equal places is nearly always the one at hand
            for i in sorted(range(b.num_rows), key=lambda i: (firsts[i] is None, firsts[i] or 0, docs[i])):
                doc, first, body, at = docs[i], firsts[i], b.column(3)[i].as_py(), b.column(4)[i].as_py()
                none, size, gone = first is None, len(body), []
                for pos in sorted(at):
                    if pos + gram > size:  # of another text with this k
                        continue
                    before, after = body[max(0, pos - reach) : pos][::-1], body[pos : pos + length]
                    if len(before) + len(after) < length:
                        continue
                    me = (none, first or 0, doc, pos)
                    other = seen.setdefault((before, after), me)
                    if other < me:  # the later of the two is repeated
                        gone.append([pos - len(before), pos + len(after)])
                    elif me < other:
                        seen[before, after] = me
                        out.append((None if other[0] else other[1], other[2], other[3] - len(before), other[3] + len(after), None, None))
                    if len(seen) > 20_000:
                        flush()
                out.extend((first, doc, x, y, None, None) for x, y in merged(gone))
                if len(out) > 10_000:
                    yield rows(out)
                    out.clear()
        flush()
        yield rows(out)

    schema = "first long, doc binary, start long, stop long, before binary, after binary"
    return texts.join(places, "k").select("k", "doc", "first", "body", "places").mapInArrow(tidied(run), schema)


def merged(spans) -> list[list[int]]:
    """The union of (start, stop) spans as maximal runs, in order."""
    runs: list = []
    for start, stop in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([start, stop])
    return runs


def _spans(around: DataFrame, length: int, gram: int, most: int) -> DataFrame:
    """(doc, start, stop) of repeated bytes; spans may overlap."""
    names = ["digest", "first", "doc", "start", "stop"]

    def compare(batches):
        """Spans, and the windows (with a digest) of groups of more than ``most`` anchors."""
        from hashlib import blake2b

        import numpy as np
        import pyarrow as pa

        types = [pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

        def rows(out):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], names=names)

        def finish(group):
            least, far = repeated_windows([g[4] for g in group], [g[5] for g in group], length, gram)
            some = np.flatnonzero(far >= 0)
            return [(None, None, group[i][2], group[i][3] - m, group[i][3] - d + length) for i, d, m in zip(some.tolist(), least[some].tolist(), far[some].tolist())]

        seen: dict = {}  # digest: the earliest place of the window so far

        def flush():
            found = [(digest, None if none else first, doc, p, p + length) for digest, (none, first, doc, p) in seen.items()]
            seen.clear()
            return found

        def windows(group):
            found = []
            for _, first, doc, pos, before, after in group:
                for d in range(max(0, length - len(after)), len(before) + 1):
                    digest = blake2b(before[:d][::-1] + after[: length - d], digest_size=16).digest()
                    me = (first is None, first or 0, doc, pos - d)
                    other = seen.setdefault(digest, me)
                    if other != me:  # two anchors may hold one window
                        late = max(me, other)
                        seen[digest] = min(me, other)
                        found.append((None, None, late[2], late[3], late[3] + length))
                if len(seen) > 100_000:
                    found += flush()
            return found

        held: list = []  # whole groups
        group: list = []  # the group at hand
        large = False
        for b in batches:
            out: list = []
            for row in zip(*(b.column(i).to_pylist() for i in range(7))):
                key, first, doc, start, stop, before, after = row
                if after is None:
                    out.append((None, None, doc, start, stop))
                    continue
                if group and group[-1][0] != key:
                    if large:
                        out += windows(group) + flush()
                    else:
                        held += group
                    group, large = [], False
                    if len(held) > 20_000:
                        out += finish(held)
                        held = []
                group.append((key, first, doc, start, before, after))
                if len(group) > most:
                    large = True
                if large and len(group) > 1000:
                    out += windows(group[:-1])  # the last row tells where the group ends
                    group = group[-1:]
                if len(out) > 50_000:
                    yield rows(out)
                    out = []
            if out:
                yield rows(out)
        yield rows((windows(group) + flush() if large else []) + finish(held + ([] if large else group)))

    def pick(batches):
        """Spans of one document merged; windows with the digest of the row before are repeated."""
        import pyarrow as pa

        last, doc_at, spans = None, None, []

        def rows(out):
            cols = list(zip(*out)) or [(), (), ()]
            return pa.record_batch([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["doc", "start", "stop"])

        for b in batches:
            out: list = []
            for digest, doc, start, stop in zip(*(b.column(i).to_pylist() for i in range(4))):
                if digest is not None:
                    if last is not None and digest == last[0] and (doc, start) != last[1:]:
                        out.append((doc, start, stop))
                    last = (digest, doc, start)
                    continue
                if doc != doc_at:
                    out += [(doc_at, x, y) for x, y in spans]
                    doc_at, spans = doc, []
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], stop)
                else:
                    spans.append([start, stop])
            if out:
                yield rows(out)
        yield rows([(doc_at, x, y) for x, y in spans])

    # equal surroundings of many tasks, and the anchors of one gram, in the documents' order
    key = F.xxhash64(F.coalesce(F.substring("after", 1, gram), F.concat("doc", F.col("start").cast("string").cast("binary"))))
    keyed = around.withColumn("key", key).repartition("key").sortWithinPartitions("key", F.asc_nulls_last("first"), "doc", "start")
    found = keyed.select("key", "first", "doc", "start", "stop", "before", "after").mapInArrow(tidied(compare), "digest binary, first long, doc binary, start long, stop long")
    found = found.repartition(F.xxhash64(F.coalesce("digest", "doc")))
    found = found.sortWithinPartitions(F.xxhash64(F.coalesce("digest", "doc")), "digest", F.asc_nulls_last("first"), "doc", "start")
    return found.select("digest", "doc", "start", "stop").mapInArrow(tidied(pick), "doc binary, start long, stop long")


def cut_texts(docs: DataFrame, length: int = 100, gram: int = GRAM, most: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(copies, texts) for the UTF-8 bytes of all texts.

    texts: per distinct text of at least ``length`` bytes: doc (its MD5), first (smallest id), kept (the bytes that stay in its first copy), spans
    (start, stop of the maximal runs that go, in order).  copies: per distinct text and id: doc, doc_id, n_bytes, whole (SHA-256 if the
    text is too short to hold a window, else null), n (rows).

    A text's place in the order is the smallest id it stands under; of texts under the same id, that of the smaller MD5 is earlier.  Null ids come last.  Null texts are empty.
    Of repeated rows one is the first and the others are copies.  Other columns are left out; an empty table gives empty tables.
    """
    copies, texts = _copies(docs, id_col, text_col, length)
    around = _surroundings(texts, _shared(_anchors(texts, length, gram)), length, gram)
    spans = _spans(around, length, gram, most)
    by_text = spans.groupBy(F.xxhash64("doc").alias("k")).agg(F.collect_list(F.struct("doc", "start", "stop")).alias("found"))

    def run(batches):
        import pyarrow as pa

        names, span = ["doc", "first", "kept", "spans"], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for b in batches:
            out: list = []
            size = 0
            for i in range(b.num_rows):
                doc, first, body, found = (b.column(c)[i].as_py() for c in (1, 2, 3, 4))
                runs = merged((f["start"], f["stop"]) for f in found or () if f["doc"] == doc)
                edges = [0, *(x for r in runs for x in r), len(body)]
                kept = b"".join(body[x:y] for x, y in zip(edges[::2], edges[1::2]))
                out.append((doc, first, kept, [{"start": x, "stop": y} for x, y in runs]))
                size += len(kept)
                if size > 1 << 24 or i == b.num_rows - 1:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), [pa.binary(), pa.int64(), pa.binary(), span])], names=names)
                    out, size = [], 0

    joined = texts.join(by_text, "k", "left").select("k", "doc", "first", "body", "found")
    return copies, joined.mapInArrow(tidied(run), "doc binary, first long, kept binary, spans array<struct<start:long,stop:long>>")


def removed_bytes(copies: DataFrame, digests: DataFrame, length: int = 100) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, from ``copies`` and (doc, first, n_removed, n_spans,
    kept_sha256) of the texts: the first copy loses its repeats, all others go whole, and texts too short for a window stay."""
    each = copies.join(digests, "doc", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    short = F.col("n_bytes") < length
    lead = (F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("first"))
    gone = F.sha2(F.lit("").cast("binary"), 256)
    return each.select(
        "doc_id",
        "n_bytes",
        F.when(short, F.lit(0)).when(lead, F.col("n_removed")).otherwise(F.col("n_bytes")).cast("long").alias("n_removed"),
        F.when(short, F.lit(0)).when(lead, F.col("n_spans")).otherwise(F.lit(1)).cast("long").alias("n_spans"),
        F.when(short, F.col("whole")).when(lead, F.col("kept_sha256")).otherwise(gone).alias("kept_sha256"),
    )


def drop_repeats(docs: DataFrame, length: int = 100, gram: int = GRAM, most: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text_col``, for the order of ``cut_texts``.

    Of rows equal in id and text, one stays.  Texts too short for a window stay as they are, null texts stay null; a text that goes whole is
    empty; what a cut leaves of a split character becomes U+FFFD.
    """
    texts = written(cut_texts(docs, length, gram, most, id_col, text_col)[1], "cut_texts")
    d, f, k = (free_name(docs, x) for x in ("_doc", "_first", "_kept"))
    body = text_of(text_col).cast("binary")
    rows = docs.withColumn(d, F.unhex(F.md5(body))).dropDuplicates([id_col, d])
    rows = rows.join(texts.select(F.col("doc").alias(d), F.col("first").alias(f), F.col("kept").alias(k)), d, "left")
    text = F.when(F.col(k).isNull(), F.col(text_col)).when(F.col(id_col).eqNullSafe(F.col(f)), F.make_valid_utf8(F.col(k).cast("string"))).otherwise("")
    return rows.withColumn(text_col, text).select(docs.columns)
