"""Toxicity by classifier chains.

Categories are predicted one after the other; each is a linear (logistic)
model over word features and over the log-odds of the categories before it.
For training, those earlier log-odds are out-of-fold predictions, so a later
model meets the errors that it will meet in use.

Features of a text are its different words (ASCII letters lowered, outer
punctuation dropped) and the 4-, 5- and 6-byte beginnings of longer words,
by 64-bit hash. The vocabulary doesn't depend on the size of the sample: a
feature is scaled by its chi-square, so the penalty weighs on those that may
be chance, which are most on small samples. Models are fitted on at most ``sample`` labelled documents
(a documented bound; which ones depends on a hash of doc_id), all counts over
that sample are made by Spark, and every document is scored, whole.

Defined cases: a null text has no features and gets the prior; labels that
are null, or of unknown documents, are not used; repeated labels of a
document count once, the largest value; without labels, or with labels of
one kind only, a category has the constant probability of its kind (0
without labels). Repeated documents are scored alike; an empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from nightjar.llm.bpe import HashTable
from nightjar.llm.tables import documents, materialize
from nightjar.llm.textbytes import _BYTE_BASE, Block, blocks, mix, powers, signed, words

#: (category, SQL condition on a row of labels), in chain order.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))
SAMPLE = 12_000
FOLDS = 3
FEATURES = 4_000                     # per category at most
MIN_DOCS = 2                         # documents of the sample that hold a feature
PREFIXES = (4, 5, 6)
THRESHOLD = 0.5
ROUNDS = 120
L2 = 0.001
SIGNIFICANT = 30.0                   # chi-square (one degree) of a feature at half the scale of a sure one

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in ".,;:!?\"'()[]{}<>*-_#%&$"]] = True


def features(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word and word beginning, with repeats."""
    data = _LOWER[b.data]
    w = words(b)
    s, e, row = w.start, w.end, w.row
    for _ in range(3):
        e = np.where((e > s) & _MARK[data[np.maximum(e - 1, 0)]], e - 1, e) if len(e) else e
        s = np.where((e > s) & _MARK[data[np.minimum(s, len(data) - 1)]], s + 1, s) if len(s) else s
    some = e > s
    s, e, row = s[some], e[some], row[some]
    p, inv = powers(_BYTE_BASE, len(data) + 1)
    acc = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:-1], out=acc[1:])
    rows, out = [row], [mix((acc[e] - acc[s]) * inv[s])]
    for k in PREFIXES:
        long = e - s > k
        at = s[long]
        rows.append(row[long])
        out.append(mix((acc[at + k] - acc[at]) * inv[at]) ^ np.uint64(k * 0x9E3779B9))
    return np.concatenate(rows), np.concatenate(out)


@dataclass
class Chain:
    """Feature hashes, per category a weight for each feature, a constant and
    a weight for each earlier category's log-odds."""

    names: list[str]
    hashes: np.ndarray
    weights: np.ndarray              # [category, feature]
    constant: np.ndarray
    earlier: np.ndarray              # [category, category]

    def score(self, rows: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
        """[row, category] probabilities; (rows, index) are the different
        (row, feature) pairs."""
        z = np.zeros((n, len(self.names)))
        for c in range(len(self.names)):
            own = np.bincount(rows, self.weights[c][index], minlength=n)[:n] if len(rows) else 0
            z[:, c] = np.clip(own + self.constant[c] + z[:, :c] @ self.earlier[c, :c], -30, 30)
        return 1 / (1 + np.exp(-z))

    def blocks(self, texts: pa.Array) -> np.ndarray:
        """Probabilities of every text of a column."""
        if not hasattr(self, "_table"):
            n = np.arange(len(self.hashes), dtype=np.int32)
            self._table = HashTable(self.hashes, n, n)
        out = []
        for b in blocks(texts):
            row, h = features(b)
            slot = self._table.find(h) if len(h) else np.zeros(0, np.int64)
            hit = slot >= 0
            pair = np.unique(row[hit] * np.int64(max(1, len(self.hashes))) + self._table.a[slot[hit]])
            width = max(1, len(self.hashes))
            out.append(self.score(pair // width, pair % width, b.hi - b.lo))
        return np.concatenate(out) if out else np.zeros((0, len(self.names)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}


def feature_scale(chi: np.ndarray) -> np.ndarray:
    """Scale of features by their chi-square, from 0 (chance) to 1 (sure)."""
    return (chi / (chi + SIGNIFICANT)) ** 2


def _logistic(rows, index, dense, y, scale, train) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, constant and dense weights of a logistic model fitted on the
    rows ``train`` (mask) by full-batch Adam with an L2 penalty. Features
    have the values ``scale``; the weights are for features of value 1."""
    n_features = len(scale)
    n = len(y)
    use = train[rows]
    r, f = rows[use], index[use]
    m = max(1, int(train.sum()))
    prior = np.clip(y[train].mean() if train.any() else 0.0, 1e-4, 1 - 1e-4)
    theta = np.zeros(n_features + dense.shape[1] + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, ROUNDS + 1):
        z = np.bincount(r, (theta[:n_features] * scale)[f], minlength=n) + dense @ theta[n_features:-1] + theta[-1]
        g = np.where(train, 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y, 0.0)
        grad = np.concatenate([np.bincount(f, g[r], minlength=n_features) * scale, dense.T @ g, [g.sum()]])
        grad[:-1] += L2 * theta[:-1]
        grad /= m
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta -= 0.15 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    return theta[:n_features] * scale, float(theta[-1]), theta[n_features:-1]


def fit_chain(rows, index, y, hashes, names, folds: int = FOLDS, scale: np.ndarray | None = None) -> Chain:
    """Chain over the (row, feature) pairs and ``y`` [row, category];
    ``scale`` [category, feature] is 1 if not given."""
    n, k = y.shape
    width = max(1, len(hashes))
    scale = np.ones((k, width)) if scale is None or not len(hashes) else scale
    weights, constant, earlier = np.zeros((k, width)), np.zeros(k), np.zeros((k, k))
    fold = np.arange(n) % folds
    odds = np.zeros((n, k))              # out-of-fold log-odds of each category
    for c in range(k):
        kinds = np.unique(y[:, c])
        if len(kinds) < 2:
            constant[c] = 30.0 if len(kinds) and kinds[0] == 1 else -30.0
            odds[:, c] = constant[c]
            continue
        for f in range(folds):
            train = fold != f
            w, b, d = _logistic(rows, index, odds[:, :c], y[:, c], scale[c], train)
            z = np.bincount(rows, w[index], minlength=n) + odds[:, :c] @ d + b
            odds[~train, c] = np.clip(z, -30, 30)[~train]
        w, b, d = _logistic(rows, index, odds[:, :c], y[:, c], scale[c], np.ones(n, dtype=bool))
        weights[c], constant[c], earlier[c, :c] = w, b, d
    return Chain(list(names), hashes, weights[:, :len(hashes)], constant, earlier)


def train(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, sample: int = SAMPLE,
          folds: int = FOLDS, n_features: int = FEATURES) -> Chain:
    names = [c for c, _ in categories]
    marks = [F.max(F.expr(f"CAST({cond} AS INT)")).alias(f"y{i}") for i, (_, cond) in enumerate(categories)]
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("l_doc")).agg(*marks)
    known = known.where(" AND ".join(f"y{i} IS NOT NULL" for i in range(len(names))))
    # The sample is bounded by its parameter, so its ids may be broadcast.
    chosen = known.orderBy(F.xxhash64("l_doc"), "l_doc").limit(sample)
    ys = [f"y{i}" for i in range(len(names))]
    texts = materialize(documents(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("l_doc"))
                        .dropDuplicates(["doc_id"]).select("doc_id", "text", *ys), "op3-sample")

    def count(batches):
        for batch in batches:
            y = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 1 + len(ys))], axis=1)
            for b in blocks(batch.column(0)):
                row, h = features(b)
                if not len(h):
                    continue
                order = np.lexsort((row, h))
                row, h = row[order], h[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                row, h = row[new], h[new]
                key, inverse = np.unique(h, return_inverse=True)
                cols = [pa.array(signed(key)), pa.array(np.bincount(inverse))]
                cols += [pa.array(np.bincount(inverse, y[b.lo + row, c]).astype(np.int64)) for c in range(len(ys))]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "n", *ys])

    schema = "key long, n long, " + ", ".join(f"{c} long" for c in ys)
    total = texts.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ys]).first()
    counts = texts.select("text", *ys).mapInArrow(count, schema).groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ["n", *ys]]).where(F.col("n") >= MIN_DOCS)
    counts = materialize(counts, "op3-counts")
    chis = []
    for c in ys:
        all_n, all_y = float(total.n or 0), float(total[c] or 0)
        # Chi-square of the 2 x 2 table (feature, category).
        n, y = F.col("n").cast("double"), F.col(c).cast("double")
        gap = y * F.lit(all_n) - n * F.lit(all_y)
        chis.append((gap * gap * F.lit(all_n) / (n * (F.lit(all_n) - n + 1) * F.lit(max(1.0, all_y))
                                                * F.lit(max(1.0, all_n - all_y)))).alias(f"chi_{c}"))
    keys: dict[int, list[float]] = {}
    for c in ys:
        best = counts.select("key", *chis).orderBy(F.col(f"chi_{c}").desc(), "key").limit(n_features)
        keys |= {r.key: [r[f"chi_{x}"] for x in ys] for r in best.collect()}
    hashes = np.array(sorted(keys), dtype=np.int64).view(np.uint64)
    scale = feature_scale(np.array([keys[h] for h in sorted(keys)]).reshape(len(keys), len(ys)).T)
    numbers = np.arange(len(hashes), dtype=np.int32)

    def select(batches):
        table = HashTable(hashes, numbers, numbers)
        for batch in batches:
            for b in blocks(batch.column(1)):
                row, h = features(b)
                slot = table.find(h) if len(h) else np.zeros(0, np.int64)
                pair = np.unique(row[slot >= 0] * np.int64(max(1, len(hashes))) + table.a[slot[slot >= 0]])
                at = np.searchsorted(pair // max(1, len(hashes)), np.arange(b.hi - b.lo + 1))
                own = (pair % max(1, len(hashes))).astype(np.int32)
                cols = [batch.column(i).slice(b.lo, b.hi - b.lo) for i in [0, *range(2, 2 + len(ys))]]
                cols.append(pa.array([own[s:e].tobytes() for s, e in zip(at, at[1:])], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *ys, "features"])

    schema = "doc_id long, " + ", ".join(f"{c} int" for c in ys) + ", features binary"
    data = sorted(texts.mapInArrow(select, schema).collect(), key=lambda r: r.doc_id)
    lists = [np.frombuffer(r.features, dtype=np.int32) for r in data]
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    index = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    y = np.array([[r[c] for c in ys] for r in data], dtype=np.float64).reshape(len(data), len(ys))
    return fit_chain(rows, index.astype(np.int64), y, hashes, names, folds, scale)


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, p_<category> and <category> (true at the threshold or over)."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = chain.names

    def run(batches):
        c = shared.value
        for batch in batches:
            p = c.blocks(batch.column(1))
            cols = [batch.column(0)]
            for i in range(len(names)):
                cols += [pa.array(p[:, i]), pa.array(p[:, i] >= threshold)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *[x for n in names for x in (f"p_{n}", n)]])

    return documents(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"p_{n} double, {n} boolean" for n in names))


def drop_toxic(docs: DataFrame, chain: Chain, category: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the chain does not put into ``category``."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at = chain.names.index(category)

    @F.pandas_udf(BooleanType())
    def toxic(text):
        import pandas as pd

        return pd.Series(shared.value.blocks(pa.array(text, pa.string(), from_pandas=True))[:, at] >= threshold)

    return docs.where(~toxic(F.coalesce(F.col("text").cast("string"), F.lit(""))))
