"""Toxicity by a classifier chain over categories.

Categories are predicted one after the other.  Each has a linear model (logistic
regression) over hashed words (and two words for the text's shape), scaled by their log-count ratio for the category, plus the
probabilities of all categories before it.  For training, those probabilities come
out of fold: a row's are predicted by models that have not seen it, so later models
learn from the errors that earlier ones make on new texts.

Models are fitted on a bounded sample of labelled rows (``LABELLED``, the smallest id
hashes; its ids are broadcast, no text is shuffled); every whole text is scored in one
narrow pass.

Defined results: a null or empty text has no words and gets the models' intercepts; a
category without both outcomes among the labelled rows gets its constant share;
labelled rows with a null in any category are not used; without labelled rows all
probabilities are zero; an id that is labelled twice is used once; an empty table gives an
empty table; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.llm.common import slices

BUCKETS = 1 << 16
LABELLED = 12_000
FOLDS = 4
STEPS = 40
LEAST_ROWS = 4         # labelled rows a word must be in
WORDS = re.compile(r"[^\W\d_]+")
SYMBOLS = "#*$%&|<>"
CACHE = 300_000


class Hasher:
    """Buckets of a text's distinct words; remembers the words it has seen, up to a bound."""

    def __init__(self):
        self.seen: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int64)
        if len(self.seen) > CACHE:
            self.seen = {}
        found = WORDS.findall(text.lower())
        words = set(found)
        # two words for the text's shape: share of distinct words, symbols per word
        n = max(len(found), 1)
        words.add(f"0distinct{10 * len(words) // n}")
        words.add(f"0symbols{min(10 * sum(map(text.count, SYMBOLS)) // n, 20)}")
        get, out = self.seen.get, []
        for w in words:
            b = get(w)
            if b is None:
                b = self.seen[w] = zlib.crc32(w.encode("utf-8", "replace")) % BUCKETS
            out.append(b)
        return np.unique(np.array(out, dtype=np.int64))


class Rows:
    """Sparse 0/1 rows."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        self.sizes = np.array([len(r) for r in rows], dtype=np.int64)
        self.at = np.concatenate([*rows, np.empty(0, np.int64)])
        self.owner = np.repeat(np.arange(self.n), self.sizes)
        self.rows = rows

    def take(self, at: np.ndarray) -> "Rows":
        return Rows([self.rows[i] for i in at])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=w[self.at], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=g[self.owner], minlength=BUCKETS)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Linear:
    """A linear model over word buckets and earlier categories' probabilities."""

    bias: float
    words: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    earlier: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def predict(self, x: Rows, p: np.ndarray) -> np.ndarray:
        z = self.bias + x.dot(self.words)
        if len(self.earlier):
            z = z + p @ self.earlier
        return sigmoid(z)


def fit_linear(x: Rows, p: np.ndarray, y: np.ndarray, steps: int = STEPS, penalty: float = 1e-3) -> Linear:
    """Logistic regression by full-batch Adam on log-count-ratio-scaled words."""
    share = float(y.mean()) if len(y) else 0.0
    d = p.shape[1]
    if share in (0.0, 1.0):
        return Linear(40.0 if share else -40.0, earlier=np.zeros(d))
    pos, neg = x.back(y), x.back(1 - y)
    ratio = np.log(((pos + 1) / (y.sum() + 2)) / ((neg + 1) / ((1 - y).sum() + 2)))
    ratio[pos + neg < LEAST_ROWS] = 0.0
    theta = np.zeros(BUCKETS + d + 1)
    theta[-1] = np.log(share / (1 - share))
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        z = x.dot(theta[:BUCKETS] * ratio) + p @ theta[BUCKETS:-1] + theta[-1]
        e = (sigmoid(z) - y) / len(y)
        g = np.concatenate([x.back(e) * ratio + penalty * theta[:BUCKETS] / len(y) * 10, p.T @ e, [e.sum()]])
        mean = 0.9 * mean + 0.1 * g
        spread = 0.99 * spread + 0.01 * g * g
        theta -= 0.08 * (mean / (1 - 0.9 ** t)) / (np.sqrt(spread / (1 - 0.99 ** t)) + 1e-9)
    return Linear(float(theta[-1]), theta[:BUCKETS] * ratio, theta[BUCKETS:-1])


def fit_chain(x: Rows, labels: np.ndarray, folds: int = FOLDS) -> list[Linear]:
    """One model per category (columns of ``labels``), in order."""
    n, k = labels.shape
    fold = np.arange(n) % folds
    p = np.zeros((n, 0))
    chain = []
    for j in range(k):
        y = labels[:, j].astype(float)
        chain.append(fit_linear(x, p, y))
        if j + 1 < k:
            out = np.zeros(n)
            for f in range(folds):
                inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                if len(inside) and len(outside):
                    model = fit_linear(x.take(inside), p[inside], y[inside])
                    out[outside] = model.predict(x.take(outside), p[outside])
            p = np.column_stack([p, out])
    return chain


def predict_chain(chain: list[Linear], x: Rows) -> np.ndarray:
    """Probability of each category, each from the words and the ones before."""
    p = np.zeros((x.n, 0))
    for model in chain:
        p = np.column_stack([p, model.predict(x, p)])
    return p


def train(docs: DataFrame, labels: DataFrame, categories: list[str], key: str = "doc_id", text: str = "text",
          most: int = LABELLED) -> list[Linear]:
    """Fit the chain from ``labels`` (key and one 0/1 column per category) and the documents' texts."""
    whole = " and ".join(f"`{c}` is not null" for c in categories)
    chosen = (labels.where(whole).where(F.col(f"`{key}`").isNotNull())
              .select(F.col(f"`{key}`").alias("k"), *[F.col(f"`{c}`").cast("int").alias(f"y{i}")
                                                     for i, c in enumerate(categories)])
              .dropDuplicates(["k"]).orderBy(F.xxhash64("k"), "k").limit(most))
    ys = [f"y{i}" for i in range(len(categories))]
    # at most ``most`` rows of an id and a few integers: a proven bound; an id with several texts gives
    # one of them, that of the smallest hash, so that what is collected is bounded too
    given = (docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
             .join(F.broadcast(chosen), "k").groupBy("k", *ys).agg(F.min_by("t", F.xxhash64("t")).alias("t")))

    def hashed(batches):
        hasher = Hasher()
        for batch in batches:
            b = [hasher(t).astype("<u2").tobytes() for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(b, pa.binary()),
                                              *[batch.column(y) for y in ys]], names=["k", "b", *ys])

    schema = T.StructType([T.StructField("k", given.schema["k"].dataType), T.StructField("b", T.BinaryType()),
                           *[T.StructField(y, T.IntegerType()) for y in ys]])
    rows = given.mapInArrow(hashed, schema).collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r["k"]).encode()), r["k"], bytes(r["b"])))
    if not rows:
        return [Linear(-1000.0, earlier=np.zeros(j)) for j in range(len(categories))]
    x = Rows([np.frombuffer(bytes(r["b"]), "<u2").astype(np.int64) for r in rows])
    return fit_chain(x, np.array([[r[y] for y in ys] for r in rows]))


def score(docs: DataFrame, chain: list[Linear], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, p): the probability of each category for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)     # a fixed number of weights
    given = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    schema = T.StructType([T.StructField("k", given.schema["k"].dataType),
                           T.StructField("p", T.ArrayType(T.DoubleType()))])

    def work(batches):
        hasher = Hasher()
        for batch in batches:
            for piece in slices(batch, "t"):
                p = predict_chain(shared.value, Rows([hasher(t) for t in piece.column("t").to_pylist()]))
                yield pa.RecordBatch.from_arrays([piece.column("k"), pa.array(p.tolist(), pa.list_(pa.float64()))],
                                                 names=["k", "p"])

    return given.mapInArrow(work, schema).withColumnRenamed("k", key)
