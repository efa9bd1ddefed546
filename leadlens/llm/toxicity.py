"""Toxic spans by a linear-chain conditional random field over words.

Two labels (toxic or not), features of the word itself, transitions between neighbours.  Training needs labelled tokens;
from document labels they are made so: a word or affix that is much commoner in toxic documents than in others marks
its tokens there.  Forward-backward marginals give spans, and a logistic model of them the document's score.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.llm.common import text_of, tidied

#: Marks around a word that don't belong to it.
EDGES = ".,;:!?\"'()[]{}<>*#$%&-_"


def word_features(word: str) -> list[str]:
    w = word.lower().strip(EDGES)
    return ["w=" + w] + [f"p{k}={w[:k]}" for k in (4, 5, 6) if len(w) > k] + [f"s4={w[-4:]}"] * (len(w) > 4)


def chain(emit, resets, trans, start):
    """Marginals of label 1 along one long chain of ``len(emit)`` tokens in which a true ``resets`` begins a new text.

    ``emit`` has the log-odds of label 1, ``trans`` the log transition weights, ``start`` those of a text's first label.
    The chain is cut into blocks whose messages are computed side by side: first each block's transfer matrix, then
    the messages between blocks, then those inside.  Returns (marginals, expected transitions 2 x 2, expected starts 2).
    """
    import numpy as np

    n = len(emit)
    size = max(1, int(np.sqrt(n)))
    blocks = -(-n // size)
    pad = blocks * size - n
    e = np.concatenate([np.clip(emit, -30, 30), np.zeros(pad)])
    r = np.concatenate([resets, np.ones(pad, bool)])
    psi = np.stack([np.exp(-np.maximum(e, 0)), np.exp(np.minimum(e, 0))], axis=1)  # scaled to at most 1
    step = np.where(r[:, None, None], np.exp(start)[None, None, :], np.exp(trans)[None]) * psi[:, None, :]
    step = step.reshape(blocks, size, 2, 2)
    total = step[:, 0].copy()
    for k in range(1, size):
        total = total @ step[:, k]
        total /= total.max(axis=(1, 2), keepdims=True)
    into = np.empty((blocks, 2))
    v = np.array([0.5, 0.5])
    for b in range(blocks):
        into[b] = v
        v = v @ total[b]
        v /= v.sum()
    back = np.empty((blocks, 2))
    v = np.array([0.5, 0.5])
    for b in range(blocks - 1, -1, -1):
        back[b] = v
        v = total[b] @ v
        v /= v.sum()
    alpha = np.empty((blocks, size, 2))
    v = into
    for k in range(size):
        v = np.einsum("bi,bij->bj", v, step[:, k])
        v = v / v.sum(axis=1, keepdims=True)
        alpha[:, k] = v
    beta = np.empty((blocks, size, 2))
    v = back
    for k in range(size - 1, -1, -1):
        beta[:, k] = v
        v = np.einsum("bij,bj->bi", step[:, k], v)
        v = v / v.sum(axis=1, keepdims=True)
    alpha, beta = alpha.reshape(-1, 2), beta.reshape(-1, 2)
    both = alpha * beta
    p = (both / both.sum(axis=1, keepdims=True))[:n]
    inner = np.flatnonzero(~r[1:n]) + 1
    pair = alpha[inner - 1][:, :, None] * np.exp(trans)[None] * (psi[inner] * beta[inner])[:, None, :]
    pair = (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if len(inner) else np.zeros((2, 2))
    return p[:, 1], pair, p[r[:n]].sum(axis=0)


@dataclass
class ToxicModel:
    """Fitted weights; small (one number per kept feature) and sent to the tasks."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    trans: tuple = (0.0, 0.0, 0.0, 0.0)
    start: tuple = (0.0, 0.0)
    document: tuple = (-3.0, 4.0, 1.0)  # bias, weight of the largest marginal, weight of log(1 + their sum)

    def __post_init__(self):
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "known"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.known = {}

    def _emit(self, words: list[str]):
        import numpy as np

        fresh = set(words).difference(self.known)
        if fresh:
            if len(self.known) > 150_000:
                self.known = {}
                fresh = set(words)
            get = self.weights.get
            for w in fresh:
                self.known[w] = self.bias + sum(get(f, 0.0) for f in word_features(w))
        return np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))

    def marginals(self, texts: list[str]) -> list:
        """Of each text, the probability of each of its words (runs without white space) to be toxic."""
        import numpy as np

        words = [t.split() for t in texts]
        sizes = np.array([len(w) for w in words])
        if not sizes.sum():
            return [np.empty(0) for _ in texts]
        ends = np.cumsum(sizes)
        resets = np.zeros(ends[-1], bool)
        resets[(ends - sizes)[sizes > 0]] = True
        emit = np.concatenate([self._emit(w) for w in words])
        p, _, _ = chain(emit, resets, np.array(self.trans).reshape(2, 2), np.array(self.start))
        return np.split(p, ends[:-1])

    @staticmethod
    def summary(p) -> tuple[float, float]:
        import math

        return (float(p.max()), math.log1p(float(p[p > 0.2].sum()))) if len(p) else (0.0, 0.0)

    def score(self, p) -> float:
        import math

        top, sum_ = self.summary(p)
        z = self.document[0] + self.document[1] * top + self.document[2] * sum_
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    @staticmethod
    def spans(text: str, p, least: float = 0.5) -> list[tuple[int, int, float]]:
        """(start, end, largest marginal) of the runs of words with a marginal of at least ``least``; characters."""
        import re

        if not len(p) or p.max() < least:
            return []
        out: list = []
        for k, m in enumerate(re.finditer(r"\S+", text)):
            if p[k] >= least:
                if out and out[-1][3] == k - 1:
                    out[-1] = (out[-1][0], m.end(), max(out[-1][2], float(p[k])), k)
                else:
                    out.append((m.start(), m.end(), float(p[k]), k))
        return [x[:3] for x in out]


def one_of_each(texts: list[str]) -> list[int]:
    """Places of the texts that share none of four minima of their 3-word shingles' hashes with an earlier one: copies in a sample
    would make any of their words look like a mark."""
    from xxhash import xxh64_intdigest

    seen: set = set()
    out = []
    for i, text in enumerate(texts):
        words = text.lower().split()
        grams = {" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))}
        hashes = [xxh64_intdigest(g) for g in grams]
        low = {(k, min(h * (2 * k + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for h in hashes)) for k in range(4)}
        if not low & seen:
            out.append(i)
        seen |= low
    return out


def token_labels(texts: list[str], toxic: list[int], ratio: float = 25.0) -> set[str]:
    """Features that mark toxic tokens: words and prefixes from 4 characters that occur in at least 4 toxic texts (1 % of many) and
    ``ratio`` times as often there as in the others."""
    from collections import Counter

    seen = {0: Counter(), 1: Counter()}
    n = Counter(toxic)
    for text, label in zip(texts, toxic):
        marks = {f for w in set(text.split()) for f in word_features(w) if f[0] != "s" and f != "w="}
        seen[label].update(marks)
    least = max(4, 0.01 * n[1])
    return {f for f, a in seen[1].items() if a >= least and (a + 0.5) / (n[1] + 1) >= ratio * (seen[0][f] + 0.5) / (n[0] + 1)}


def fit(texts: list[str], toxic: list[int], epochs: int = 40, rate: float = 0.5, l2: float = 1e-4, around: int = 8, window: int = 64) -> ToxicModel:
    """Fits the field on token windows and the document model on whole texts, all of the given sample."""
    import numpy as np

    model = ToxicModel()
    if not texts or len(set(toxic)) < 2:
        share = sum(toxic) / len(toxic) if toxic else 0.0
        model.document = (float(np.log((share + 0.01) / (1.01 - share))), 0.0, 0.0)
        return model
    apart = one_of_each(texts)
    texts, toxic = [texts[i] for i in apart], [toxic[i] for i in apart]
    marks = token_labels(texts, toxic)
    words, labels, first = [], [], []
    for i, (text, label) in enumerate(zip(texts, toxic)):
        ws = text.split()
        if not ws:
            continue
        if label:
            bad = [any(f in marks for f in word_features(w)) for w in ws]
            hot = [k for k, b in enumerate(bad) if b]
            spans: list = []
            for k in hot:
                lo, hi = max(0, k - around), min(len(ws), k + around + 1)
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = hi
                else:
                    spans.append([lo, hi])
        else:
            bad = [False] * len(ws)
            lo = (i * 7919) % max(1, len(ws) - window + 1)
            spans = [[lo, min(len(ws), lo + window)]]
        for lo, hi in spans:
            first += [True] + [False] * (hi - lo - 1)
            words += ws[lo:hi]
            labels += bad[lo:hi]
    y, resets = np.array(labels, float), np.array(first, bool)
    ids: dict[str, int] = {}
    cols, rows = [], []
    for k, w in enumerate(words):
        for f in word_features(w):
            rows.append(k)
            cols.append(ids.setdefault(f, len(ids)))
    rows, cols = np.array(rows), np.array(cols)
    theta, bias, trans, start = np.zeros(len(ids)), -2.0, np.zeros((2, 2)), np.zeros(2)
    yi = y.astype(int)
    inner = np.flatnonzero(~resets[1:]) + 1
    seen_pair = np.bincount(2 * yi[inner - 1] + yi[inner], minlength=4).reshape(2, 2)
    seen_start = np.bincount(yi[resets], minlength=2)
    state = [np.full(len(ids), 1e-8), 1e-8, np.full((2, 2), 1e-8), np.full(2, 1e-8)]
    n = len(y)
    for _ in range(epochs):  # full-batch Adagrad on the log-likelihood
        emit = bias + np.bincount(rows, theta[cols], minlength=n)
        p, pair, starts = chain(emit, resets, trans, start)
        gap = y - p
        grads = [np.bincount(cols, gap[rows], minlength=len(ids)) / 50 - l2 * theta, gap.sum() / 50, (seen_pair - pair) / 50, (seen_start - starts) / 50]
        for s, g in enumerate(grads):
            state[s] = state[s] + g * g
        theta = theta + rate * grads[0] / np.sqrt(state[0])
        bias += rate * grads[1] / np.sqrt(state[1])
        trans = np.clip(trans + rate * grads[2] / np.sqrt(state[2]), -5, 5)
        start = np.clip(start + rate * grads[3] / np.sqrt(state[3]), -5, 5)
    model.weights = {f: float(theta[k]) for f, k in ids.items() if abs(theta[k]) > 1e-2}
    model.bias, model.trans, model.start = float(bias), tuple(trans.ravel().tolist()), tuple(start.tolist())

    x = []
    for lo in range(0, len(texts), 256):
        x += [(1.0, *model.summary(p)) for p in model.marginals(texts[lo : lo + 256])]
    x, t, w = np.array(x), np.array(toxic, float), np.array([-3.0, 4.0, 1.0])
    for _ in range(25):  # Newton steps with a ridge
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (t - q) - 0.5 * w
        hess = (x * (q * (1 - q))[:, None]).T @ x + 0.5 * np.eye(3)
        w = w + np.linalg.solve(hess, grad)
    model.document = tuple(float(v) for v in w)
    return model


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text has remainder 2 by 4; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, most: int = 2000, longest: int = 40_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicModel:
    """A model from the labelled rows that aren't held out: of each label at most ``most`` texts, of at most ``longest``
    characters each, those with the smallest hash of their id.  Scores use no label, lang, source or id.
    Rows with a null label or text, and repeated texts, are left out; without labelled rows all scores are equal."""
    known = labels.filter(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("i"), F.col(label_col).alias("y"))
    known = known.filter(~held_out(F.col("i"))).groupBy("i").agg(F.max("y").alias("y"))
    short = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter(F.length("t") <= longest)
    texts, toxic, seen = [], [], set()
    for label in (0, 1):
        some = known.filter(F.col("y") == label).withColumn("h", F.xxhash64("i", F.lit(label)))
        chosen = some.orderBy("h", "i").limit(most)
        for r in short.join(F.broadcast(chosen), "i").orderBy("h", "i").select("t").limit(most).collect():
            if r["t"] not in seen:
                seen.add(r["t"])
                texts.append(r["t"])
                toxic.append(label)
    return fit(texts, toxic)


def score_documents(docs: DataFrame, model: ToxicModel, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, spans (start, end, probability of the offending words).

    Null and empty texts get the score of a text without words; repeated rows equal scores; an empty table gives no row;
    other columns are ignored.  ``predicted`` is 1 from ``threshold`` on.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("probability", T.DoubleType())]))),
        ]
    )

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = part.column(1).to_pylist()
                ps = model.marginals(texts)
                spans = [[{"start": s, "end": e, "probability": x} for s, e, x in model.spans(t, p)] for t, p in zip(texts, ps)]
                yield pa.record_batch([part.column(0), pa.array([model.score(p) for p in ps], pa.float64()), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    out = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(tidied(run), schema)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")


def drop_toxic(docs: DataFrame, model: ToxicModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; the rest passes unchanged, without a shuffle.

    A null text is judged as the empty one; equal rows stay or go alike; an empty table stays empty."""
    place = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ps = model.marginals([t or "" for t in part.column(place).to_pylist()])
                yield part.filter(pa.array([model.score(p) < threshold for p in ps], pa.bool_()))

    return docs.mapInArrow(tidied(run), docs.schema)
