"""SimHash near-duplicates with pivot distance tables.

Fingerprint: 64 bits, one per majority of the XXH64 values of all word shingles.
Equal fingerprints are one point from here on, so exact copies cost nothing more.

Search: the 64 bits are cut into 6 blocks, and every block has reference
fingerprints (pivots) of its width.  A point's pivot table holds its Hamming distance
to every pivot.  Distances obey the triangle inequality, so two points d bits apart
differ by at most d in every coordinate.  Two points at most 3 bits apart differ in at
most 3 blocks: in at least 3 of the 6 their coordinates are equal.  So for each of the
20 choices of 3 blocks the points are grouped by those coordinates; within a group
pairs whose largest coordinate difference exceeds 3 are discarded, and the survivors
verified bit by bit.  No linked pair is missed, whatever the pivots.

A group never emits its pairs: its verified links are merged at once (union-find) and
one edge per point to its component's smallest member leaves the task.  A large group is
cut again by the same argument: 4 parts of the bits left open, of which one must be
equal.  Components over all edges come from star contraction on joins, staged in shared
storage after each round.

Defined results: a null or empty text has fingerprint zero and links like any other;
repeated rows share their component; a null id never becomes a component's name unless
all its ids are null; of each component one row is kept, also where rows share an id or have
none; an empty table gives an empty table; extra columns are not read, but tell kept rows apart.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.llm.common import slices, stage

BITS = 64
BLOCKS = 6
PIVOTS = 16            # reference fingerprints per block
DIRECT = 1024          # points compared directly within a group; larger ones are cut again
SEED = 42


# ---- fingerprints ----------------------------------------------------------
def fingerprint(text: bytes, shingle: int = 3, chunk: int = 1 << 15) -> int:
    """SimHash of a text's word shingles (bytes of its UTF-8, A-Z lowered)."""
    words = text.lower().split()     # bytes: lowers A-Z only, splits at space and 0x09-0x0D
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[k:] for k in range(shingle)))))
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(grams), chunk):
        part = grams[i:i + chunk]
        h = np.array([xxhash.xxh64_intdigest(g, SEED) for g in part], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(grams)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, also=()) -> DataFrame:
    """One row per input row: the key, the columns of ``also`` and ``fp`` (the fingerprint's 64 bits as a long)."""
    given = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("binary").alias("t"), *also)
    schema = T.StructType([*[T.StructField(c, given.schema[c].dataType) for c in ("k", *also)],
                           T.StructField("fp", T.LongType())])

    def work(batches):
        for batch in batches:
            for piece in slices(batch, "t"):
                fps = np.array([fingerprint(t, shingle) if t else 0 for t in piece.column("t").to_pylist()],
                               dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in ("k", *also)],
                                                  pa.array(fps.view(np.int64))], names=["k", *also, "fp"])

    return given.mapInArrow(work, schema).withColumnRenamed("k", key)


# ---- pivot tables ------------------------------------------------------------
def blocks(n: int = BLOCKS) -> list[tuple[int, int]]:
    """(shift, width) of each block of bits."""
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


@functools.lru_cache(maxsize=8)
def pivots(n_blocks: int = BLOCKS, per_block: int = PIVOTS) -> list[np.ndarray]:
    """Reference fingerprints of each block: the empty one, then ones drawn from a fixed seed."""
    rng = np.random.default_rng(SEED)
    return [np.concatenate([[0], rng.integers(0, 1 << width, per_block - 1)]).astype(np.uint64)
            for _, width in blocks(n_blocks)]


def pivot_table(fps: np.ndarray, n_blocks: int = BLOCKS, per_block: int = PIVOTS) -> np.ndarray:
    """Hamming distance of every point to every pivot: (points, blocks, pivots)."""
    out = np.empty((len(fps), n_blocks, per_block), np.uint8)
    for b, ((shift, width), refs) in enumerate(zip(blocks(n_blocks), pivots(n_blocks, per_block))):
        part = (fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        out[:, b, :] = np.bitwise_count(part[:, None] ^ refs[None, :])
    return out


def group_keys(table: np.ndarray, limit: int) -> tuple[np.ndarray, int]:
    """For every point and every choice of blocks that must agree: a hash of their coordinates."""
    n, n_blocks, _ = table.shape
    choices = list(itertools.combinations(range(n_blocks), n_blocks - limit))
    keys = np.empty((n, len(choices)), np.int64)
    for c, chosen in enumerate(choices):
        rows = np.ascontiguousarray(table[:, chosen, :]).reshape(n, -1)
        keys[:, c] = [xxhash.xxh3_64_intdigest(r.tobytes(), c) >> 1 for r in rows]
    return keys, len(choices)


class Links:
    """Union-find over the points of one group."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def link_direct(fps: np.ndarray, table: np.ndarray, at: np.ndarray, limit: int, links: Links) -> None:
    """Discard pairs by their largest coordinate difference, verify the others."""
    flat = table[at].reshape(len(at), -1).astype(np.int16)
    for i in range(len(at) - 1):
        near = np.flatnonzero(np.abs(flat[i + 1:] - flat[i]).max(axis=1) <= limit) + i + 1
        for j in near[np.bitwise_count(fps[at[near]] ^ fps[at[i]]) <= limit]:
            links.join(int(at[i]), int(at[j]))


def link_group(fps: np.ndarray, limit: int) -> list[int]:
    """Component representative (position) of every point of a group of distinct points."""
    links, table = Links(len(fps)), pivot_table(fps)

    def cut(at: np.ndarray) -> None:
        differ = np.bitwise_or.reduce(fps[at] ^ fps[at[0]])
        open_bits = [b for b in range(BITS) if int(differ) >> b & 1]
        if len(at) <= DIRECT or len(open_bits) <= limit:
            if len(open_bits) <= limit:        # all are within the limit of each other
                for j in at[1:]:
                    links.join(int(at[0]), int(j))
            else:
                link_direct(fps, table, at, limit, links)
            return
        for part in range(limit + 1):
            mask = sum(1 << b for b in open_bits[part::limit + 1])
            values = fps[at] & np.uint64(mask)
            order = np.argsort(values, kind="stable")
            edges = np.flatnonzero(np.diff(values[order])) + 1
            for run in np.split(order, edges):
                # a run whose points are linked already has nothing to add
                if len(run) > 1 and len({links.find(int(x)) for x in at[run]}) > 1:
                    cut(at[run])

    if len(fps) > 1:
        cut(np.arange(len(fps)))
    return [links.find(i) for i in range(len(fps))]


# ---- candidate links -----------------------------------------------------------
def link_edges(points: DataFrame, limit: int = 3) -> DataFrame:
    """Edges (a > b) between distinct fingerprints ``fp`` that connect all linked points."""
    def keyed(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            if len(fps):
                keys, n = group_keys(pivot_table(fps.view(np.uint64)), limit)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.repeat(fps, n))],
                                                 names=["g", "fp"])

    def grouped(batches):
        held_g, held_fp = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held_g = np.concatenate([held_g, batch.column("g").to_numpy(zero_copy_only=False)])
                held_fp = np.concatenate([held_fp, batch.column("fp").to_numpy(zero_copy_only=False)])
                if not len(held_g):
                    continue
                cut = np.searchsorted(held_g, held_g[-1])     # the last group may go on in the next batch
            else:
                cut = len(held_g)
            done_g, done_fp = held_g[:cut], held_fp[:cut]
            held_g, held_fp = held_g[cut:], held_fp[cut:]
            starts = np.flatnonzero(np.diff(done_g, prepend=done_g[:1] - 1))
            ends = np.append(starts[1:], len(done_g))
            a, b = [], []
            for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
                own = np.unique(done_fp[s:e])
                for i, root in enumerate(link_group(own.view(np.uint64), limit)):
                    if root != i:
                        a.append(max(own[i], own[root]))
                        b.append(min(own[i], own[root]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    groups = points.select("fp").mapInArrow(keyed, "g long, fp long")
    return (groups.repartition("g").sortWithinPartitions("g")
            .mapInArrow(grouped, "a long, b long").distinct())


# ---- components ------------------------------------------------------------------
def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge, root being the component's smallest node.

    Large-star and small-star rounds: each node's neighbours are hung under the smallest
    of them; the rounds end when all edges form stars.  Hot nodes cost one partial
    aggregate per task, and their edges are split by the skew join.
    """
    edges = stage(edges.select("a", "b"), "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").where("b > a and b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(joined.select("a", F.col("m").alias("b"))).distinct())
        edges = stage(small, "edges")
        now = edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def rooted(points: DataFrame, limit: int) -> DataFrame:
    """The points (column ``fp``, others pass through) with their component's smallest one, ``root``."""
    hung = points.join(components(link_edges(points, limit)).withColumnRenamed("node", "fp"), "fp", "left")
    return hung.withColumn("root", F.coalesce("root", "fp"))


def cluster(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, limit: int = 3) -> DataFrame:
    """One row per input row: key, ``fp`` (long) and ``component_id`` (smallest key reachable)."""
    coded = stage(fingerprints(df, key, text, shingle), "fingerprints")
    points = stage(coded.groupBy("fp").agg(F.min(key).alias("first")), "points")
    hung = rooted(points, limit)
    names = hung.groupBy("root").agg(F.min("first").alias("component_id"))
    named = hung.join(names, "root").select("fp", "component_id")
    return coded.join(named, "fp").select(key, "fp", "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, limit: int = 3) -> DataFrame:
    """One row of each component (the smallest key, nulls last, then the smallest hashes), all its columns.

    A row is known by its key and two hashes, of its text and of all its columns: rows that
    share an id, or have none, stay apart, and only rows equal in everything are one.
    """
    own = [f"in_{i}" for i in range(len(df.columns))]     # by position, so that none clashes with the hashes
    k, t = own[df.columns.index(key)], own[df.columns.index(text)]
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, own)])
    hashed = [F.col(f.name) for f in rows.schema if "map<" not in f.dataType.simpleString()]
    marked = rows.withColumns({"t_hash": F.xxhash64(F.lit("text"), F.col(t)), "r_hash": F.xxhash64(F.lit("row"), *hashed)})
    coded = fingerprints(marked, k, t, shingle, ("t_hash", "r_hash"))
    name = F.struct(F.col(k).isNull().alias("none"), F.col(k).alias("f_key"), F.col("t_hash").alias("f_text"),
                    F.col("r_hash").alias("f_row"))
    points = stage(coded.groupBy("fp").agg(F.min(name).alias("first")), "points")
    chosen = rooted(points, limit).groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    kept = marked.join(chosen, F.col(k).eqNullSafe(F.col("f_key")) & (F.col("t_hash") == F.col("f_text"))
                       & (F.col("r_hash") == F.col("f_row")))
    return kept.dropDuplicates([k, "t_hash", "r_hash"]).select(*[F.col(n).alias(c) for c, n in zip(df.columns, own)])
