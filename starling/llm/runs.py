"""Periodic run detection: an online sparse diagonal DP over the words of a text.

A run is a maximal stretch of words with smallest period q, at least ``times`` periods and
``least`` words long.  Words are read once, left to right.  A diagonal is a lag d whose words
match (word i equals word i - d); the active diagonals hold where their match began.  At each
word the active diagonals grow or end, and one that ends with sufficient length emits its
run at once.  New diagonals come from the word's earlier occurrences.

Sparse: a run's match spans 3 d words at least (``times`` - 1 periods), so that a lag in
[2^k, 2^(k+1)) has to be looked for at multiples of 2^k only; a word looks at its earlier
occurrences within reach of the largest power of two that divides its number, and the match is
followed back to its beginning.  Hence n log n looks, not the square of a word's frequency.
A multiple of an active lag whose stretch spans a whole period is no smallest period and is
not opened, so that a text of one repeated word has one active diagonal.

Memory: the words of one text, one number per word, and the active diagonals.  One text is one
row, handled in one task; batches are cut by bytes.

Defined results: a null, empty or blank text has no words and no runs; repeated rows give
repeated rows; a null key is kept (``repeat_tail`` leaves its words alone); an empty table
gives no rows; other columns are not read.  Words are bytes between white space
(space and 0x09-0x0D), whatever they hold.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.llm.common import slices

LEAST = 6     # words
TIMES = 4     # periods


def find_runs(words: Sequence, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period; ``times`` is 3 at least."""
    if times < 3:
        raise ValueError("times: 3 at least, as lags are looked for once in d words")
    active: dict[int, int] = {}        # lag -> first word that equals the one a lag before
    last: dict = {}                    # word -> its latest number
    before: list[int] = []             # number of the same word's occurrence before
    found: dict[tuple[int, int], int] = {}

    def end(lag: int, first: int, i: int) -> None:
        length = i - first + lag
        if length >= least and length >= times * lag:
            at = (first - lag, length)
            # a stretch with several periods counts with its smallest
            found[at] = min(lag, found.get(at, lag))

    for i, w in enumerate(words):
        if active:
            over = [d for d in active if words[i - d] != w]
            for d in over:
                end(d, active.pop(d), i)
        j = last.get(w, -1)
        before.append(j)
        last[w] = i
        reach = 2 * (i & -i)
        if j < 0 or i - j >= reach:
            continue
        # lags whose stretch up to here repeats twice: their multiples are no smallest periods
        steady = [(q, first) for q, first in active.items() if i - first >= q]
        while j >= 0 and i - j < reach:
            d = i - j
            # a run's match holds three multiples of the lag's power of two, so that one of
            # them has the one before in the match too
            step = 1 << (d.bit_length() - 1)
            if (j >= step and words[i - 1] == words[j - 1] and words[i - step] == words[j - step]
                    and d not in active and not any(d % q == 0 and i - first + q >= d for q, first in steady)):
                first = i - 1
                while first > d and words[first - 1] == words[first - 1 - d]:
                    first -= 1
                active[d] = first
                if i - first >= d:
                    steady.append((d, first))
            j = before[j]
    for d, first in active.items():
        end(d, first, len(words))
    return sorted((start, length, q) for (start, length), q in found.items())


def collapse(words: Sequence, runs) -> list:
    """The words without those that any run repeats: each run's first period stays."""
    kept, at = [], 0
    spans = sorted((start + q, start + length) for start, length, q in runs)
    for first, stop in spans:
        if first > at:
            kept.extend(words[at:first])
        at = max(at, stop)
    kept.extend(words[at:])
    return kept


def repeat_tail(key, words: list) -> list:
    """Words of every tenth key (by crc32 of its decimal text) with a repeated tail.

    With h the crc32, g = h // 10 and h % 10 = 0, the words from a = g % n on repeat the first
    p = 1 + (n - a) // (3 + g % 8) of them.
    """
    n = len(words)
    if key is None or not n:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[:n - a]


SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def detect(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES,
           rewrite: Callable[[object, list], list] | None = None) -> DataFrame:
    """One row per input row: key, n_words, runs (start, length, period) and the collapsed text.

    ``rewrite(key, words)`` may replace a text's words before they are read.
    """
    name = "_key" if key in ("n_words", "runs", "collapsed") else key
    docs = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("binary").alias("t"))
    span = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([T.StructField("k", docs.schema["k"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(span)), T.StructField("collapsed", T.BinaryType())])

    def work(batches):
        for batch in batches:
            for piece in slices(batch, "t"):
                counts, runs, texts = [], [], []
                for k, t in zip(piece.column("k").to_pylist(), piece.column("t").to_pylist()):
                    words = (t or b"").split()
                    if rewrite is not None:
                        words = rewrite(k, words)
                    spans = find_runs(words, least, times)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in spans])
                    texts.append(b" ".join(collapse(words, spans) if spans else words))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("k"), pa.array(counts, pa.int64()), pa.array(runs, pa.list_(SPAN)),
                     pa.array(texts, pa.binary())], names=["k", "n_words", "runs", "collapsed"])

    return docs.mapInArrow(work, schema).select(F.col("k").alias(name), "n_words", "runs",
                                                F.col("collapsed").cast("string").alias("collapsed"))


def longest(runs: F.Column) -> F.Column:
    """The run with the greatest length; ties go to the smallest start, then period."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("q")))
    best = F.array_min(ranked)
    return F.when(F.size(runs) > 0, F.struct(best["s"].alias("start"), (-best["n"]).alias("length"),
                                             best["q"].alias("period")))
