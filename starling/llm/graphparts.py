"""Approximate nearest neighbours with learned partitions.

Fitting, on a bounded sample (``SAMPLE`` vectors with the smallest id hashes):
  * the neighbour graph of the sample;
  * its balanced partitioning: parts of equal size grown from a sweep along principal
    directions and refined by moving vertices to where most of their neighbours are,
    never past a capacity;
  * a small classifier (one hidden layer) that learns a vector's part;
  * the number of parts to probe: the fewest that reach the target recall against
    brute force for the sample's own vectors.
Indexing: the classifier puts every row into its most probable part.
Search: a query is routed to its most probable parts, and all rows there are reranked
by the exact inner product in double precision.

At scale rows and queries meet in blocks: a part is cut into row blocks by an id hash
(copies of one vector spread over them) and into query blocks; a task holds one
row block and one query block; every query keeps only its best of a block.

Defined results: vectors that are null, empty, zero, or hold null, NaN or infinite
components take no part, neither do those of another length than the sample's first;
rows are told apart by their id, a repeated query id is searched once; ties go to
the smaller id; an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAMPLE = 4096
PARTS = 16
NEIGHBOURS = 10
HIDDEN = 64
TARGET = 0.95          # recall asked for on the sample when choosing the number of probes
ROW_BLOCK = 8192
QUERY_BLOCK = 8192
SEED = 7


# ---- fitting (numpy, bounded sample) -------------------------------------------
def neighbour_graph(x: np.ndarray, k: int, block: int = 512) -> np.ndarray:
    """Positions of each vector's k nearest others by inner product."""
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), block):
        s = x[i:i + block] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i:i + block] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 30, slack: float = 1.1) -> np.ndarray:
    """Part of each vertex: halved along principal directions, then refined on the graph."""
    n = len(x)
    label = np.zeros(n, np.int64)

    def halve(at: np.ndarray, first: int, count: int) -> None:
        if count == 1 or len(at) < 2:
            label[at] = first
            return
        centred = x[at] - x[at].mean(axis=0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = at[np.argsort(centred @ axis, kind="stable")]
        left = count // 2
        cut = len(order) * left // count
        halve(order[:cut], first, left)
        halve(order[cut:], first + left, count - left)

    halve(np.arange(n), 0, parts)
    capacity = int(np.ceil(n / parts * slack))
    source = np.repeat(np.arange(n), graph.shape[1])
    a = np.concatenate([source, graph.reshape(-1)])
    b = np.concatenate([graph.reshape(-1), source])     # undirected
    size = np.bincount(label, minlength=parts)
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (a, label[b]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        moved = 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if size[best[v]] < capacity:
                size[label[v]] -= 1
                size[best[v]] += 1
                label[v] = best[v]
                moved += 1
        if not moved:
            break
    return label


class Router:
    """A classifier with one hidden layer, from vectors to parts."""

    def __init__(self, w1, b1, w2, b2, probes: int = 1):
        self.w1, self.b1, self.w2, self.b2, self.probes = w1, b1, w2, b2, probes

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(unit(x) @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def part(self, x: np.ndarray) -> np.ndarray:
        return self.scores(x).argmax(axis=1)

    def route(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :self.probes]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def train_router(x: np.ndarray, label: np.ndarray, parts: int, hidden: int = HIDDEN, epochs: int = 60) -> Router:
    """Softmax regression on rectified features, Adam on mini-batches of a fixed seed."""
    rng = np.random.default_rng(SEED)
    d = x.shape[1]
    theta = [rng.normal(0, np.sqrt(2 / d), (d, hidden)), np.zeros(hidden),
             rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    mean, spread = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    x, step = unit(x) , 0
    for epoch in range(epochs):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            z = x[at] @ theta[0] + theta[1]
            h = np.maximum(z, 0)
            logit = h @ theta[2] + theta[3]
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(at)), label[at]] -= 1
            p /= len(at)
            back = (p @ theta[2].T) * (z > 0)
            grads = [x[at].T @ back, back.sum(0), h.T @ p, p.sum(0)]
            step += 1
            for k, g in enumerate(grads):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                spread[k] = 0.999 * spread[k] + 0.001 * g * g
                theta[k] = theta[k] - 0.01 * (mean[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(spread[k] / (1 - 0.999 ** step)) + 1e-8)
    return Router(*theta)


def choose_probes(router: Router, x: np.ndarray, parts: int, k: int, target: float, queries: int = 256) -> int:
    """The fewest parts that hold ``target`` of the true neighbours of sample vectors."""
    at = np.arange(len(x))[:: max(1, len(x) // queries)]
    s = x[at] @ x.T
    s[np.arange(len(at)), at] = -np.inf
    k = min(k, len(x) - 1)
    true = np.argpartition(-s, k - 1, axis=1)[:, :k]
    own = router.part(x)
    place = np.argsort(np.argsort(-router.scores(x[at]), axis=1, kind="stable"), axis=1)
    rank = np.take_along_axis(place, own[true], axis=1)
    for probes in range(1, parts + 1):
        if (rank < probes).mean() >= target:
            return probes
    return parts


def fit(sample: np.ndarray, parts: int = PARTS, k: int = 20, target: float = TARGET) -> Router:
    """Router for a sample of vectors (rows)."""
    x = np.asarray(sample, dtype=np.float64)
    parts = max(1, min(parts, len(x) // 32))
    if parts == 1:
        d = x.shape[1]
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = neighbour_graph(x, min(NEIGHBOURS, len(x) - 1))
    router = train_router(x, balanced_parts(x, graph, parts), parts)
    router.probes = choose_probes(router, x, parts, k, target)
    return router


# ---- vectors on Spark -------------------------------------------------------------
def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x) of rows whose vector can take part, as doubles."""
    x = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    some = F.exists(x, lambda v: v != 0)
    return (df.select(F.col(f"`{key}`").alias("k"), x.alias("x"), bad.alias("bad"), some.alias("some"))
            .where("k is not null and x is not null and not bad and some").select("k", "x"))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in one fixed order."""
    return np.multiply(q, x).sum(axis=1)


def best_of_block(q_ids, q, r_ids, r, k: int, step: int = 256):
    """Each query's k best rows of a block: (query id, row id, score), ties to the smaller id."""
    for i in range(0, len(q_ids), step):
        s = q[i:i + step] @ r.T
        s[q_ids[i:i + step, None] == r_ids[None, :]] = -np.inf
        if len(r_ids) > k:
            bound = -np.partition(-s, k - 1, axis=1)[:, k - 1]
            # rows within rounding of the bound are all rescored
            a, b = np.nonzero(s >= (bound - 1e-9 * (1 + np.abs(bound)))[:, None])
        else:
            a, b = np.nonzero(np.isfinite(s))
        ok = np.isfinite(s[a, b])
        a, b = a[ok], b[ok]
        score = np.empty(len(a))
        for j in range(0, len(a), 65536):
            score[j:j + 65536] = exact(q[i + a[j:j + 65536]], r[b[j:j + 65536]])
        order = np.lexsort((r_ids[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        first = np.searchsorted(a, a, side="left")
        top = np.arange(len(a)) - first < k
        yield q_ids[i + a[top]], r_ids[b[top]], score[top]


def search(rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
           parts: int = PARTS, sample: int = SAMPLE, target: float = TARGET) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows found for each query."""
    spark = rows.sparkSession
    rows, queries = usable(rows, key, vector), usable(queries, key, vector).dropDuplicates(["k"])
    taken = rows.orderBy(F.xxhash64("k"), "k").limit(sample).toPandas()
    if taken.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = len(taken["x"].iloc[0])
    router = fit(np.array([v for v in taken["x"] if len(v) == d]), parts, k, target)
    shared = spark.sparkContext.broadcast(router)
    rows, queries = rows.where(F.size("x") == d), queries.where(F.size("x") == d)
    n_parts = router.w2.shape[1]

    def index(batches):
        for batch in batches:
            x = matrix(batch.column("x"), d)
            if len(x):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.part(x).astype(np.int32))],
                                                 names=["k", "x", "part"])

    def route(batches):
        for batch in batches:
            x = matrix(batch.column("x"), d)
            if len(x):
                probes = shared.value.route(x).astype(np.int32)
                at = pa.array(np.repeat(np.arange(len(x)), probes.shape[1]))
                yield pa.RecordBatch.from_arrays([batch.column("k").take(at), batch.column("x").take(at),
                                                  pa.array(probes.reshape(-1))], names=["k", "x", "part"])

    placed = "k long, x array<double>, part int"
    n_rows, n_queries = rows.count(), queries.count()
    # blocks of bounded size: every part is cut alike, by hashes of the ids
    row_blocks = max(1, -(-n_rows // (n_parts * ROW_BLOCK)))
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    left = (rows.mapInArrow(index, placed)
            .withColumn("rb", F.pmod(F.xxhash64("k"), F.lit(row_blocks)).cast("int"))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    right = (queries.mapInArrow(route, placed)
             .withColumn("qb", F.pmod(F.xxhash64("k"), F.lit(query_blocks)).cast("int"))
             .withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))))

    def rerank(r: pa.Table, q: pa.Table) -> pa.Table:
        found = []
        if r.num_rows and q.num_rows:
            r, q = r.combine_chunks(), q.combine_chunks()
            found = list(best_of_block(q.column("k").to_numpy(), matrix(q.column("x").combine_chunks(), d),
                                       r.column("k").to_numpy(), matrix(r.column("x").combine_chunks(), d), k))
        cols = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 2 + [np.empty(0)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    met = (left.groupBy("part", "rb", "qb").cogroup(right.groupBy("part", "rb", "qb"))
           .applyInArrow(rerank, "query_id long, vec_id long, score double"))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (met.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
