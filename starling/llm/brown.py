"""Brown class-based n-grams: exchange clustering, smoothed class bigram scores.

Model: log10 P(text) = sum over tokens of log10 P(class | previous class) + log10 P(word | class),
both with additive smoothing; a text is followed by one end token, which also stands
before its first word.

Every training word is assigned to a class by exchange: in each round words move to the class that
raises the class bigram likelihood most, given everyone else's class.  Half of the words have their turn in
a round, as all move at once; a round that lowers the likelihood is taken back and tried again in
two parts, they in two parts, down to a ``MOST_PARTS``-th of the words.  No word is dropped.

Frequent words (at least those with a share of 1/``SHARE`` of the training tokens, at most
2 ``SHARE``: the bound of everything broadcast) start by rank in ``CLASSES`` classes, all others, the tail,
by their last byte in ``RARE`` more.  ``ROUNDS`` rounds move frequent words alone, so that classes tell
something when the tail's turn comes; then as many rounds move all words, to any of the ``CLASSES``.  The
end has a class of its own.

Passes over the texts (words stay bytes of the text; no vocabulary reaches the driver whole):
  1. per block of tokens, words with a share of 1/(2 SHARE) there.  A word frequent overall
     has at least half its count in such reports, so summed reports bound the candidates
     by 2 SHARE and lose none.
  2. exact successor counts between frequent words, per block, added up over the blocks by
     bucket of pairs and gathered into one staged adjacency row per word.
  3. each block of documents as numbers, staged: frequent words by id, tail words by their place among the
     block's own.  Tail words go as 64-bit keys, with their pairs in training texts, to the task of
     their bucket.  A tail word is in at most 1/SHARE of the tokens: no bucket is hot.
In a round the buckets of the tail exchange classes: two buckets list the pairs between their words in the
same order, so that one byte a pair tells the neighbours' classes.  At the end each block gets the class and
the count of each of its tail words, never a row each, and its documents are scored.

Defined results: a null or empty text has the end token only; a null id counts as the empty id
(held out); repeated rows are documents each; without training text all counts are zero and
probabilities uniform; an empty table gives an empty table.  Words over 64 bytes are told
apart by a 128-bit digest, tail words by a 64-bit key: 60 bits of a hash and 4 of the last byte.  Words
without a training count are in the class that a word of the tail starts in.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from starling.llm.common import slices, stage

SHARE = 50_000
CLASSES = 64
RARE = 16
ROUNDS = 8
BLOCK_TOKENS = 4_000_000
BUCKET_ROWS = 1_000_000    # tokens per bucket of pairs
SMOOTH = 0.1           # of counts in emissions, as in the unigram base
SMOOTH_CLASS = 0.5     # of counts in transitions
LONG_WORD = 64
MOVE_WORDS = 1024      # of the tail, tried at once
MOST_PARTS = 16        # of a round that lowers the likelihood


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lowered, split at space and 0x09-0x0D; very long ones as digests."""
    if not text:
        return []
    words = text.lower().split()
    if len(text) > LONG_WORD and len(max(words, key=len, default=b"")) > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else b"\xff" + hashlib.blake2b(w, digest_size=16).digest() for w in words]
    return words


def rare_class(word: bytes) -> int:
    return word[-1] % RARE


class Ids(dict):
    """Word -> id; a word without one gets the pseudo id of its rare class (after the end token)."""

    def __missing__(self, word: bytes) -> int:
        return self.first_rare + word[-1] % RARE

    def __init__(self, words):
        super().__init__((w, i) for i, w in enumerate(words))
        self.end = len(words)
        self.first_rare = len(words) + 1


def documents(df: DataFrame, key: str, text: str) -> DataFrame:
    held = F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    return df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), held.alias("held_out"),
                     F.col(f"`{text}`").cast("binary").alias("t"))


# ---- pass 1: candidates --------------------------------------------------------
def candidates(train: DataFrame, share: int = SHARE) -> tuple[list[bytes], int]:
    """Words that may be frequent (at most 2 share of them), and the number of training tokens."""
    def report(batches):
        counter, n = Counter(), 0

        def flush():
            least = n / (2 * share)
            out = [(w, c) for w, c in counter.items() if c >= least]
            return pa.RecordBatch.from_arrays(
                [pa.array([b"", *(w for w, _ in out)], pa.binary()), pa.array([n, *(c for _, c in out)], pa.int64())],
                names=["w", "n"])

        for batch in batches:
            for piece in slices(batch, "t"):
                for t in piece.column("t").to_pylist():
                    words = words_of(t)
                    counter.update(words)
                    n += len(words) + 1
                if n >= BLOCK_TOKENS:
                    yield flush()
                    counter, n = Counter(), 0
        if n:
            yield flush()

    sums = stage(train.select("t").mapInArrow(report, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")),
                 "reports")
    total = sums.where("w = X''").agg(F.sum("n")).first()[0] or 0
    rows = sums.where(F.col("w") != F.lit(b"")).where(F.col("n") >= total / (2 * share)).select("w").collect()
    return sorted(bytes(r["w"]) for r in rows), total


# ---- pass 2: successor counts -----------------------------------------------------
def adjacency(train: DataFrame, words: list[bytes], total: int) -> DataFrame:
    """One staged row per word or pseudo word: w, successors and predecessors as packed (id, count).

    Counts of one pair are added up over all blocks before a word's row is gathered, so a row
    holds every neighbour once.  Pairs go to buckets by parts of both ids; a word's pairs
    spread over more buckets as blocks grow in number, so that no bucket does.
    """
    shared = train.sparkSession.sparkContext.broadcast(words)
    parts = max(1, min(64, -(-total // BUCKET_ROWS)))
    spread = max(1, -(-total // (16 * BLOCK_TOKENS)))

    def packed(codes: np.ndarray, counts: np.ndarray, size: int, forward: bool):
        own, other = (codes // size, codes % size) if forward else (codes % size, codes // size)
        both = np.empty(len(own), PAIR)
        both["id"], both["n"] = other, counts
        return by_bucket(both, own, np.ndarray.tobytes)

    def count(batches):
        ids = Ids(shared.value)
        size, end = ids.first_rare + RARE, ids.end
        held: list[np.ndarray] = []
        n = 0

        def flush():
            codes, counts = np.unique(np.concatenate(held), return_counts=True)
            rows = np.stack([codes, counts], axis=1)
            buckets, blobs = by_bucket(rows, codes // size % parts * spread + codes % size % spread, pack_pairs)
            return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(blobs, pa.binary())],
                                              names=["bucket", "b"])

        for batch in batches:
            for piece in slices(batch, "t"):
                flat = [end]
                for t in piece.column("t").to_pylist():
                    flat.extend(map(ids.__getitem__, words_of(t)))
                    flat.append(end)
                row = np.array(flat, dtype=np.int64)
                held.append(row[:-1] * size + row[1:])
                n += len(row)
                if n >= BLOCK_TOKENS:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    size = len(words) + 1 + RARE

    def add(group: pa.Table) -> pa.Table:
        rows = np.concatenate([unpack_pairs(b) for b in group.column("b").to_pylist()])
        codes, which = np.unique(rows[:, 0], return_inverse=True)
        counts = np.zeros(len(codes), np.int64)
        np.add.at(counts, which, rows[:, 1])
        w, blobs = packed(codes, counts, size, True)
        w2, blobs2 = packed(codes, counts, size, False)
        return pa.table({"w": pa.array(np.concatenate([w, w2]), pa.int32()),
                         "ahead": pa.array([True] * len(w) + [False] * len(w2)),
                         "b": pa.array(blobs + blobs2, pa.binary())})

    rows = (train.select("t").mapInArrow(count, "bucket long, b binary")
            .groupBy("bucket").applyInArrow(add, "w int, ahead boolean, b binary"))
    lists = rows.groupBy("w").agg(F.collect_list(F.when(F.col("ahead"), F.col("b"))).alias("after"),
                                  F.collect_list(F.when(~F.col("ahead"), F.col("b"))).alias("before"))
    # several files, so that every core gets a share of the words
    return stage(lists.repartition(2 * train.sparkSession.sparkContext.defaultParallelism, "w"), "adjacency")


PAIR = np.dtype([("id", "<u4"), ("n", "<u8")])


def pack_pairs(rows: np.ndarray) -> bytes:
    """(code, count) rows in ascending code order as compressed columns, codes as differences."""
    columns = (np.diff(rows[:, 0], prepend=0), rows[:, 1].astype("<u4"))
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns))


def unpack_pairs(blob: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = len(data) // 12
    return np.stack([np.cumsum(np.frombuffer(data, "<i8", n)), np.frombuffer(data, "<u4", n, 8 * n)], axis=1)


def unpack(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(blobs), PAIR)
    return both["id"].astype(np.int64), both["n"].astype(np.float64)


def word_counts(table: DataFrame) -> dict[int, int]:
    """Training count of every candidate, pseudo word and the end (at most 2 SHARE + RARE + 1 rows)."""
    def total(batches):
        for batch in batches:
            n = [int(unpack(b)[1].sum()) for b in batch.column("after").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("w"), pa.array(n, pa.int64())], names=["w", "n"])

    return {r["w"]: r["n"] for r in table.select("w", "after").mapInArrow(total, "w int, n long").collect()}


# ---- exchange clustering --------------------------------------------------------------
def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(n: np.ndarray) -> float:
    """Class bigram log-likelihood, without the part that classes do not change."""
    return float(xlogx(n).sum() - xlogx(n.sum(axis=1)).sum() - xlogx(n.sum(axis=0)).sum())


def best_class(a: int, after: np.ndarray, before: np.ndarray, own: float, n: np.ndarray, movable: int):
    """Class for a word of class ``a`` and the gain of moving it there.

    ``after``/``before``: its counts with the next/previous class, without itself; ``own``: with itself.
    """
    m = n.copy()
    m[a, :] -= after
    m[:, a] -= before
    m[a, a] -= own
    count = after.sum() + own
    rows, cols = m.sum(axis=1), m.sum(axis=0)
    gain = (xlogx(m + after) - xlogx(m)).sum(axis=1) + (xlogx(m + before[:, None]) - xlogx(m)).sum(axis=0)
    d = np.diagonal(m)
    gain += xlogx(d + after + before + own) - xlogx(d + after) - xlogx(d + before) + xlogx(d)
    # every class gets its pairs with the word back, wherever the word goes
    rows, cols = rows + before, cols + after
    gain -= xlogx(rows + count) - xlogx(rows) + xlogx(cols + before.sum() + own) - xlogx(cols)
    gain = gain[:movable]
    b = int(gain.argmax())
    return (b, float(gain[b] - gain[a])) if gain[b] > gain[a] + 1e-9 else (a, 0.0)


def best_classes(a: np.ndarray, after: tuple, before: tuple, own: np.ndarray, n: np.ndarray, movable: int):
    """``best_class`` of many words of classes ``a``, from the classes that they do have beside them.

    ``after``/``before``: (word, class, count) columns in order, each pair once, without pairs of a word with itself.
    """
    words, k = len(a), len(n)
    gain, stay = np.zeros((words, k)), np.zeros(words)
    for (w, j, c), (w2, j2, c2), m in ((after, before, n), (before, after, n.T)):
        # whole rows: they get all of the word's pairs, its own class had them before
        count, total = np.bincount(w, c, words) + own, m.sum(axis=1)
        kinds, which = np.unique(count, return_inverse=True)
        gain -= (xlogx(total + kinds[:, None]) - xlogx(total))[which]
        stay -= xlogx(total[a]) - xlogx(total[a] - count)
        if not len(w):
            continue
        # cells of each class that is beside the word, alike for all words with the same count of it
        code, which = np.unique(j * (1 << 40) + c.astype(np.int64), return_inverse=True)
        cells = m[:, code >> 40].T
        cells = xlogx(cells + (code % (1 << 40))[:, None]) - xlogx(cells)
        starts = np.flatnonzero(np.diff(w, prepend=-1))
        gain[w[starts]] += np.add.reduceat(cells[which], starts, axis=0)
        home = j == a[w]
        x = m[a[w], j][~home]
        stay += np.bincount(w[~home], xlogx(x) - xlogx(x - c[~home]), words)
        # cells with its own class have lost the word's pairs of the other side
        near = np.bincount(w[home], c[home], words)
        at = (near[w2] > 0) & (j2 != a[w2])
        x, lost, near = m[j2[at], a[w2[at]]], c2[at], near[w2[at]]
        gain[w2[at], j2[at]] += xlogx(x - lost + near) - xlogx(x - lost) - xlogx(x + near) + xlogx(x)
    # diagonal cells get the pairs of both sides and of the word with itself
    d = np.diagonal(n)
    (w, j, c), (w2, j2, c2) = after, before
    _, i, i2 = np.intersect1d(w * k + j, w2 * k + j2, assume_unique=True, return_indices=True)
    of, at, x, y = w[i], j[i], c[i], c2[i2]
    gain[of, at] += xlogx(d[at] + x + y + own[of]) - xlogx(d[at] + x) - xlogx(d[at] + y) + xlogx(d[at])
    for v in np.flatnonzero(own):
        x, y = np.zeros(k), np.zeros(k)
        x[j[w == v]], y[j2[w2 == v]] = c[w == v], c2[w2 == v]
        gain[v] += np.where((x > 0) & (y > 0), 0.0,
                            xlogx(d + x + y + own[v]) - xlogx(d + x) - xlogx(d + y) + xlogx(d))
    both = own + sum(np.bincount(w[j == a[w]], c[j == a[w]], words) for w, j, c in (after, before))
    at = np.arange(words)
    gain[at, a] = stay + xlogx(d[a]) - xlogx(d[a] - both)
    best = gain[:, :movable].argmax(axis=1)
    return np.where(gain[at, best] > gain[at, a] + 1e-9, best, a)


def transitions(table: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    """Class bigram counts between the words and the end that ``classes`` has, by id; pseudo words are left out."""
    shared = table.sparkSession.sparkContext.broadcast(classes)

    def count(batches):
        of = shared.value
        n = np.zeros((k, k))
        for batch in batches:
            for w, blobs in zip(batch.column("w").to_pylist(), batch.column("after").to_pylist()):
                if w < len(of):
                    ids, c = unpack(blobs)
                    n[of[w]] += np.bincount(of[ids[ids < len(of)]], weights=c[ids < len(of)], minlength=k)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n.reshape(-1)[at])], names=["at", "n"])

    rows = table.select("w", "after").mapInArrow(count, "at long, n double").groupBy("at").agg(F.sum("n")).collect()
    n = np.zeros(k * k)
    for at, c in rows:
        n[at] = c
    return n.reshape(k, k)


# ---- pass 3: blocks as numbers, pairs of the tail by bucket ---------------------------
CODED = "bucket long, block long, docs binary, blob binary"
TAIL = "bucket long, keys binary, asks binary, lists binary"
SENT = "bucket long, src long, after binary, before binary, moved long"
NO_BUCKET = -1


def squeeze(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(len(a) for a in arrays)], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(
        a.dtype.char.encode() + a.tobytes() for a in arrays))


def expand(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = np.frombuffer(data, np.int64, 1)[0]
    at, out = 8 * (n + 1), []
    for size in np.frombuffer(data, np.int64, n, 8).tolist():
        kind = np.dtype(chr(data[at]))
        out.append(np.frombuffer(data, kind, size, at + 1))
        at += 1 + size * kind.itemsize
    return out


def steps(a: np.ndarray, kind: str) -> np.ndarray:
    """An ascending column as differences."""
    return np.diff(a, prepend=a.dtype.type(0)).astype(kind)


def cut_points(at: np.ndarray, buckets: np.ndarray) -> list[slice]:
    """Where each of ``buckets`` stands in an ascending column."""
    return [slice(*p) for p in zip(np.searchsorted(at, buckets), np.searchsorted(at, buckets, side="right"))]


def by_bucket(rows: np.ndarray, at: np.ndarray, pack) -> tuple[np.ndarray, list[bytes]]:
    """The buckets of ``rows`` and the packed rows of each."""
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    ends = np.append(starts[1:], len(at))
    return at[starts], [pack(rows[s:e]) for s, e in zip(starts, ends)]


def key_of(word: bytes) -> int:
    """64-bit key of a tail word; its last four bits give its rare class."""
    return xxhash.xxh3_64_intdigest(word) // RARE * RARE + rare_class(word)


class Places(dict):
    """Word -> id; other words get numbers after the end's in order of their first use."""

    def __init__(self, words):
        super().__init__((w, i) for i, w in enumerate(words))
        self.end = len(words)
        self.tail: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.tail.append(word)
        self[word] = found = self.end + len(self.tail)
        return found


def encode(docs: DataFrame, words: list[bytes], buckets: int) -> DataFrame:
    """Staged rows of blocks: one with its documents as numbers, one per bucket of its tail words.

    A block's tail words are numbered by (bucket, key).  A bucket's row has their keys, their pairs with frequent
    words in training texts, and their pairs with tail words: those they are left in and those they are
    right in, both in the order of (left, right).
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def code(batches):
        def fresh():
            return Places(shared.value), [], [], []

        def flush(block):
            end, first = ids.end, ids.end + 1
            at = np.concatenate(flat)
            sizes = np.array(counts)
            keys = np.array([key_of(w) for w in ids.tail], dtype=np.uint64)
            order = np.lexsort((keys, keys // RARE % buckets))
            new = np.diff(keys[order], prepend=keys[order[:1]] + np.uint64(1)) != 0     # of equal keys one word
            place = np.empty(len(keys), np.int64)
            place[order] = np.cumsum(new) - 1
            keys = keys[order][new]
            of = (keys // RARE % buckets).astype(np.int64)
            tail = at >= first
            at[tail] = first + place[at[tail] - first]
            meta = pa.concat_arrays([d for d, _ in docs_held])
            held = np.concatenate([h for _, h in docs_held])
            yield (NO_BUCKET, block, squeeze(meta.fill_null(0).to_numpy(zero_copy_only=False), meta.is_null().to_numpy(
                zero_copy_only=False), held, sizes.astype("<u4")), squeeze(at.astype("<u4")))

            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            before = np.empty_like(at)
            before[1:] = at[:-1]
            before[starts] = end
            train = np.repeat(~held, sizes)
            l, r = before[train], at[train]
            lt, rt = l >= first, r >= first
            size = 2 * (first + 1)          # a frequent word's id or, for pairs of a word with itself, the next one
            own = lt & rt & (l == r)
            near, n_near = np.unique(np.concatenate([
                (l[lt & ~rt] - first) * size + 2 * r[lt & ~rt], (r[rt & ~lt] - first) * size + 2 * l[rt & ~lt] + 1,
                (l[own] - first) * size + 2 * first]), return_counts=True)
            both = lt & rt & ~own
            pairs, n_pairs = np.unique((l[both] - first) * len(keys) + r[both] - first, return_counts=True)
            left, right = (pairs // len(keys), pairs % len(keys)) if len(pairs) else (pairs, pairs)
            into = np.argsort(of[right], kind="stable")
            present = np.unique(of)
            spans, nears = cut_points(of, present), cut_points(of[near // size], present)
            outs, ins = cut_points(of[left], present), cut_points(of[right[into]], present)
            for b, span, x, o, i in zip(present.tolist(), spans, nears, outs, ins):
                i = into[i]
                yield b, block, None, squeeze(
                    steps(keys[span], "u8"), steps(near[x] // size - span.start, "<u4"), (near[x] % size).astype("<u4"),
                    n_near[x].astype("<u4"), (left[o] - span.start).astype("<u4"), of[right[o]].astype("<u4"),
                    n_pairs[o].astype("<u4"), (right[i] - span.start).astype("<u4"), of[left[i]].astype("<u4"),
                    n_pairs[i].astype("<u4"))

        def rows(found):
            for row in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                    names=["bucket", "block", "docs", "blob"])

        ids, flat, counts, docs_held = fresh()
        block = n = 0
        for batch in batches:
            for piece in slices(batch, "t"):
                if not counts:
                    block = piece.column("rid")[0].as_py()
                of_piece = []
                for t in piece.column("t").to_pylist():
                    own = list(map(ids.__getitem__, words_of(t)))
                    of_piece += own
                    of_piece.append(ids.end)
                    counts.append(len(own) + 1)
                flat.append(np.array(of_piece, dtype=np.int64))
                docs_held.append((piece.column("doc_id"), piece.column("held_out").to_numpy(zero_copy_only=False)))
                n += len(of_piece)
                if n >= BLOCK_TOKENS:
                    yield from rows(flush(block))
                    ids, flat, counts, docs_held = fresh()
                    n = 0
        if counts:
            yield from rows(flush(block))

    given = docs.withColumn("rid", F.monotonically_increasing_id())
    return stage(given.mapInArrow(code, CODED), "coded")


def tail_table(coded: DataFrame, end: int) -> DataFrame:
    """Staged, a row per bucket: its words' keys and counts, which of them each block asks for, and their pairs."""
    alone = 2 * (end + 1)

    def build(group: pa.Table) -> pa.Table:
        given = sorted(zip(group.column("block").to_pylist(), group.column("blob").to_pylist()))
        parts = [expand(b) for _, b in given]
        sizes = [len(p[0]) for p in parts]
        keys, which = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)
        places = np.split(which, np.cumsum(sizes)[:-1])
        code, at = np.unique(np.concatenate([
            w[np.cumsum(p[1], dtype=np.int64)] * (alone + 2) + p[2] for w, p in zip(places, parts)]), return_inverse=True)
        n = np.bincount(at, np.concatenate([p[3] for p in parts]), len(code))
        own, code = code // (alone + 2), code % (alone + 2)
        # pairs with one bucket stand together, in order of block and (left, right) on both sides
        lists = []
        for i in (4, 7):
            w, other, c = (np.concatenate(x) for x in zip(*((v[p[i]], p[i + 1], p[i + 2]) for v, p in zip(places, parts))))
            order = np.argsort(other, kind="stable")
            with_, size = np.unique(other, return_counts=True)
            lists += [w[order].astype("<u4"), c[order], with_, size.astype("<u4")]
        count = np.bincount(lists[0], lists[1], len(keys)) + np.bincount(own[code % 2 == 0], n[code % 2 == 0], len(keys))
        return pa.table({
            "bucket": group.column("bucket").slice(0, 1).cast(pa.int64()),
            "keys": pa.array([squeeze(steps(keys, "u8"), count.astype("<u8"))], pa.binary()),
            "asks": pa.array([squeeze(np.array([b for b, _ in given], "<i8"), np.array(sizes, "<u4"),
                                      which.astype("<u4"))], pa.binary()),
            "lists": pa.array([squeeze(steps(own, "<u4"), code.astype("<u4"), n.astype("<u4"), *lists)], pa.binary())})

    rows = coded.where(F.col("bucket") != NO_BUCKET).select("bucket", "block", "blob")
    return stage(rows.groupBy("bucket").applyInArrow(build, TAIL), "tail")


@dataclass
class Bucket:
    """Pairs of a bucket's words: with frequent words (even codes: after, odd: before, the last: itself) and with the tail."""
    own: np.ndarray
    code: np.ndarray
    n: np.ndarray
    out: tuple          # word that is left, count, buckets of the right ones and how many pairs each has
    into: tuple

    @classmethod
    def read(cls, blob: bytes) -> Bucket:
        a = expand(blob)
        return cls(np.cumsum(a[0], dtype=np.int64), a[1].astype(np.int64), a[2], tuple(a[3:7]), tuple(a[7:11]))

    def told(self, bucket: int, classes: np.ndarray, moved: int) -> pa.Table:
        """Rows that tell the buckets beside it its words' classes, pair by pair, and one for itself."""
        rows = {}
        for side, (w, _, others, sizes) in enumerate((self.out, self.into)):
            ends = np.cumsum(sizes)
            for o, size, e in zip(others.tolist(), sizes.tolist(), ends.tolist()):
                rows.setdefault(o, [None, None])[side] = squeeze(classes[w[e - size:e]])
        to = [bucket, *rows]
        return pa.table({
            "bucket": pa.array(to, pa.int64()), "src": pa.array([NO_BUCKET] + [bucket] * len(rows), pa.int64()),
            "after": pa.array([squeeze(classes), *(o for o, _ in rows.values())], pa.binary()),
            "before": pa.array([None, *(i for _, i in rows.values())], pa.binary()),
            "moved": pa.array([moved] + [0] * len(rows), pa.int64())})


def heard(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of a bucket's words, of the words right of its pairs and of those left of them."""
    rows = rows.sort_by("src")
    own = expand(rows.column("after")[0].as_py())[0]
    # what another bucket's words are left in, this one's are right in
    after, before = ([expand(b)[0] for b in rows.column(c).to_pylist()[1:] if b is not None] for c in ("before", "after"))
    return own, *(np.concatenate(x) if x else np.empty(0, "u1") for x in (after, before))


def first_classes(tail: DataFrame, k: int) -> DataFrame:
    def begin(batches):
        for batch in batches:
            for b, keys, lists in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "lists"))):
                keys = np.cumsum(expand(keys)[0], dtype=np.uint64)
                yield from Bucket.read(lists).told(b, (k + keys % RARE).astype("u1"), 0).to_batches()

    return stage(tail.select("bucket", "keys", "lists").mapInArrow(begin, SENT), "sent")


def tail_contexts(lists: DataFrame, sent: DataFrame, end: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class bigram counts within the tail; counts of (frequent word, after or before, class) of the tail, coded."""
    chunk = 4096 * 2 * k
    alone = 2 * (end + 1)

    def count(given: pa.Table, told: pa.Table) -> pa.Table:
        if not given.num_rows or not told.num_rows:
            return pa.table({"part": pa.array([], pa.int64()), "blob": pa.array([], pa.binary())})
        x = Bucket.read(given.column("lists")[0].as_py())
        own, right, _ = heard(told)
        own = own.astype(np.int64)
        m = np.bincount(own[x.out[0]] * k + right, x.out[1], k * k)
        self_ = x.code == alone
        m += np.bincount(own[x.own[self_]] * (k + 1), x.n[self_], k * k)
        # what is after a word of the tail has that word before it
        near, at = np.unique((x.code[~self_] ^ 1) * k + own[x.own[~self_]], return_inverse=True)
        n = np.bincount(at, x.n[~self_], len(near))
        parts = np.unique(near // chunk)
        spans = cut_points(near // chunk, parts)
        return pa.table({"part": pa.array([-1, *parts.tolist()], pa.int64()), "blob": pa.array(
            [squeeze(np.arange(k * k), m), *(squeeze(near[p], n[p]) for p in spans)], pa.binary())})

    def add(group: pa.Table) -> pa.Table:
        codes, n = (np.concatenate(x) for x in zip(*(expand(b) for b in group.column("blob").to_pylist())))
        codes, at = np.unique(codes, return_inverse=True)
        return pa.table({"part": group.column("part").slice(0, 1),
                         "blob": pa.array([squeeze(codes, np.bincount(at, n, len(codes)))], pa.binary())})

    out = "part long, blob binary"
    found = lists.groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInArrow(count, out)
    # at most 4 SHARE k numbers
    rows = {r["part"]: expand(bytes(r["blob"])) for r in found.groupBy("part").applyInArrow(add, out).collect()}
    within = rows.pop(-1, (None, np.zeros(k * k)))[1].reshape(k, k)
    found = [rows[p] for p in sorted(rows)]
    codes, n = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0))
    return within, codes, n


def tail_moves(lists: DataFrame, sent: DataFrame, classes: np.ndarray, n: np.ndarray, movable: int, turn: int,
               parts: int) -> DataFrame:
    """Staged: the classes of the tail after words whose turn it is have moved."""
    shared = lists.sparkSession.sparkContext.broadcast((classes, n))
    alone = 2 * len(classes)

    def move(given: pa.Table, told: pa.Table) -> pa.Table:
        of, counts = shared.value
        k = len(counts)
        if not given.num_rows or not told.num_rows:
            return told.slice(0, 0).select(["bucket", "src", "after", "before", "moved"])
        bucket = given.column("bucket")[0].as_py()
        x = Bucket.read(given.column("lists")[0].as_py())
        own, right, left = heard(told)
        # every ``parts``-th word; buckets begin apart
        movers = (np.arange(len(own)) + bucket) % parts == turn
        number = np.cumsum(movers) - 1
        sides = []
        for odd, (w, c, *_), beside in ((0, x.out, right), (1, x.into, left)):
            near = (x.code % 2 == odd) & (x.code != alone) & movers[x.own]
            far = movers[w]
            code, at = np.unique(np.concatenate([number[x.own[near]] * k + of[x.code[near] // 2],
                                                 number[w[far]] * k + beside[far]]), return_inverse=True)
            sides.append((code // k, code % k, np.bincount(at, np.concatenate([x.n[near], c[far]]), len(code))))
        self_ = (x.code == alone) & movers[x.own]
        total = int(movers.sum())
        itself = np.bincount(number[x.own[self_]], x.n[self_], total)
        was = own[movers].astype(np.int64)
        now = was.copy()
        for lo in range(0, total, MOVE_WORDS):
            hi = min(lo + MOVE_WORDS, total)
            some = []
            for w, j, c in sides:
                p = slice(*np.searchsorted(w, [lo, hi]))
                some.append((w[p] - lo, j[p], c[p]))
            now[lo:hi] = best_classes(was[lo:hi], *some, itself[lo:hi], counts, movable)
        new = own.copy()
        new[movers] = now
        return x.told(bucket, new, int((now != was).sum()))

    return stage(lists.groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInArrow(move, SENT), "sent")


def frequent_moves(table: DataFrame, classes: np.ndarray, n: np.ndarray, near: tuple, movable: int, turn: int,
                   parts: int) -> np.ndarray:
    """Classes of the frequent words after those whose turn it is have moved; ``near``: their counts with the tail."""
    k, end = len(n), len(classes) - 1
    codes, counts = near
    shared = table.sparkSession.sparkContext.broadcast((classes, n, codes, counts))

    def moves(batches):
        of, n, codes, counts = shared.value
        for batch in batches:
            w_out, c_out = [], []
            for w, *sides in zip(*(batch.column(c).to_pylist() for c in ("w", "after", "before"))):
                if w >= end or xxhash.xxh32_intdigest(w.to_bytes(4, "little")) % parts != turn:
                    continue
                own, found = 0.0, []
                for side, blobs in enumerate(sides):
                    ids, c = unpack(blobs)
                    known = ids <= end
                    p = slice(*np.searchsorted(codes, [(2 * w + side) * k, (2 * w + side + 1) * k]))
                    own = float(c[ids == w].sum())
                    found.append(np.bincount(of[ids[known]], c[known], k) + np.bincount(codes[p] % k, counts[p], k))
                    found[-1][of[w]] -= own
                b, gain = best_class(int(of[w]), *found, own, n, movable)
                if gain > 0:
                    w_out.append(w)
                    c_out.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(w_out, pa.int32()), pa.array(c_out, pa.int32())], names=["w", "c"])

    new = classes.copy()
    for w, c in table.mapInArrow(moves, "w int, c int").collect():
        new[w] = c
    return new


def exchange(table: DataFrame, lists: DataFrame, sent: DataFrame, classes: np.ndarray, k: int, movable: int,
             rounds: int = ROUNDS) -> tuple[np.ndarray, DataFrame, np.ndarray, list[float]]:
    """Improve the classes of frequent words (``classes``, the end's last) and of the tail (``sent``).

    First ``rounds`` of frequent words alone, then as many of all words.  Returns both, their class bigram counts
    (the last of ``k`` classes is the end's) and the likelihood after each round.
    """
    def whole(classes, within, near):
        n = within + transitions(table, classes, k)
        own, side, other = classes[near[0] // (2 * k)], near[0] // k % 2, near[0] % k
        for s, at in ((0, own * k + other), (1, other * k + own)):
            n = n + np.bincount(at[side == s], near[1][side == s], k * k).reshape(k, k)
        return n

    within, *near = tail_contexts(lists, sent, len(classes) - 1, k)
    n = whole(classes, within, near)
    history = [likelihood(n)]
    for with_tail in (False, True):
        still = 0
        for r in range(rounds):
            tries, any_moved = [(r % 2, 2)], False
            while tries:
                turn, parts = tries.pop(0)
                new = frequent_moves(table, classes, n, near, movable, turn, parts)
                told, moved = sent, int((new != classes).sum())
                if with_tail:
                    told = tail_moves(lists, sent, classes, n, movable, turn, parts)
                    moved += told.agg(F.sum("moved")).first()[0] or 0
                if not moved:
                    continue
                any_moved = True
                of_tail = tail_contexts(lists, told, len(classes) - 1, k) if with_tail else (within, *near)
                m = whole(new, of_tail[0], of_tail[1:])
                if likelihood(m) > likelihood(n):
                    classes, sent, n, (within, *near) = new, told, m, of_tail
                elif parts < MOST_PARTS:
                    tries += [(turn, 2 * parts), (turn + parts, 2 * parts)]
            history.append(likelihood(n))
            still = 0 if any_moved else still + 1
            if still == 2:
                break
    return classes, sent, n, history


@dataclass
class ClassModel:
    words: list[bytes]         # frequent words, by id
    classes: np.ndarray        # class of each of them and of the end
    counts: np.ndarray         # training tokens of each of them and of the end
    moves: np.ndarray          # class bigram counts
    total: int                 # training tokens
    history: list[float]       # likelihood at first and after each round
    coded: DataFrame           # all documents as numbers
    tail: DataFrame            # the other words, by bucket
    sent: DataFrame            # their classes


def fit(docs: DataFrame, share: int = SHARE, k: int = CLASSES, rounds: int = ROUNDS) -> ClassModel:
    """Learn classes and counts of all words from the training documents among ``docs``."""
    spark = docs.sparkSession
    train = docs.where("not held_out").select("t")
    found, total = candidates(train, share)
    table = adjacency(train, found, total)
    counts = word_counts(table)
    end = len(found)
    c = np.array([counts.get(i, 0) for i in range(end + 1)], dtype=np.int64)
    # up to 64 small buckets, for the sake of the cores, then large ones, as buckets tell each other classes
    coded = encode(docs, found, max(1, min(64, -(-4 * total // BUCKET_ROWS)), -(-total // (4 * BUCKET_ROWS))))
    tail = tail_table(coded, end)
    # classes: k by rank, RARE by last byte, the end's
    classes = np.full(end + 1, k + RARE, np.int64)
    classes[np.argsort(-c[:end], kind="stable")] = np.arange(end) % k
    # kept in place, so that a round moves classes only
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = tail.select("bucket", "lists").repartition(partitions, "bucket").persist(StorageLevel.DISK_ONLY)
    try:
        classes, sent, n, history = exchange(table, lists, first_classes(tail, k), classes, k + RARE + 1, k, rounds)
    finally:
        lists.unpersist()
    return ClassModel(words=found, classes=classes, counts=c, moves=n, total=total, history=history, coded=coded,
                      tail=tail, sent=sent)


# ---- scores ---------------------------------------------------------------------------
REPLY = "block long, bucket long, blob binary, kinds array<long>"
OF_DOC = "doc_id long, held_out boolean, n_tokens long, n_known long, s double, m double"


def replies(tail: DataFrame, sent: DataFrame, k: int) -> DataFrame:
    """Staged: per block and bucket classes and counts of the words asked for; per bucket its training words by class."""
    def reply(given: pa.Table, told: pa.Table) -> pa.Table:
        if not given.num_rows or not told.num_rows:
            given = given.slice(0, 0)
        blocks, blobs, kinds = [], [], []
        for bucket, keys, asks in zip(*(given.column(c).to_pylist() for c in ("bucket", "keys", "asks"))):
            classes, count = expand(told.column("after")[0].as_py())[0], expand(keys)[1]
            of, sizes, which = expand(asks)
            blocks = [*of.tolist(), None]
            blobs = [squeeze(classes[w], count[w]) for w in np.split(which, np.cumsum(sizes)[:-1])] + [None]
            kinds = [None] * len(of) + [np.bincount(classes[count > 0], minlength=k).tolist()]
        bucket = [bucket] * len(blocks) if blocks else []
        return pa.table({"block": pa.array(blocks, pa.int64()), "bucket": pa.array(bucket, pa.int64()),
                         "blob": pa.array(blobs, pa.binary()), "kinds": pa.array(kinds, pa.list_(pa.int64()))})

    own = sent.where(F.col("src") == NO_BUCKET).select("bucket", "after")
    return stage(tail.select("bucket", "keys", "asks").groupBy("bucket").cogroup(own.groupBy("bucket"))
                 .applyInArrow(reply, REPLY), "replies")


def score(df: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE, k: int = CLASSES,
          rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity per document."""
    model = fit(documents(df, key, text), share, k, rounds)
    size = len(model.moves)
    answers = replies(model.tail, model.sent, size)
    rare = answers.where("block is null").agg(*[F.sum(F.get("kinds", i)).alias(f"v{i}") for i in range(size)]).first()
    kinds = np.array([int(v or 0) for v in rare]) + np.bincount(model.classes, model.counts > 0, size).astype(np.int64)
    base_mass = math.log10(model.total + SMOOTH * (int(kinds.sum()) + 1))
    log_mass = np.log10(model.moves.sum(axis=0) + SMOOTH * (kinds + 1))
    log_move = np.log10((model.moves + SMOOTH_CLASS) / (model.moves.sum(axis=1, keepdims=True) + SMOOTH_CLASS * size))
    shared = df.sparkSession.sparkContext.broadcast((model.classes, model.counts, log_move, log_mass))

    def add(given: pa.Table, told: pa.Table) -> pa.Table:
        classes, counts, log_move, log_mass = shared.value
        parts = [expand(b) for b in told.sort_by("bucket").column("blob").to_pylist()]
        classes, counts = (np.concatenate([x, *y]) for x, y in zip((classes, counts), zip(*parts) if parts else ((), ())))
        ids, nulls, held, sizes = expand(given.column("docs")[0].as_py())
        at = expand(given.column("blob")[0].as_py())[0]
        sizes = sizes.astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        cls, c = classes[at].astype(np.int64), counts[at]
        before = np.empty_like(cls)
        before[1:] = cls[:-1]
        before[starts] = size - 1
        s = np.add.reduceat(np.log10(c + SMOOTH), starts)
        m = np.add.reduceat(log_move[before, cls] - log_mass[cls], starts)
        known = np.add.reduceat((c > 0).astype(np.int64), starts)
        return pa.table({"doc_id": pa.array(ids, mask=nulls), "held_out": pa.array(held), "n_tokens": pa.array(sizes),
                         "n_known": pa.array(known), "s": pa.array(s), "m": pa.array(m)})

    blocks = model.coded.where(F.col("bucket") == NO_BUCKET).select("block", "docs", "blob")
    told = answers.where("block is not null").select("block", "bucket", "blob")
    found = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(add, OF_DOC).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(model.total)).cast("long").alias("train_tokens"),
        (F.col("s") - F.col("n_tokens") * F.lit(base_mass)).alias("base_score"), (F.col("s") + F.col("m")).alias("score"))
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
