"""Sharding by a two-pass external shuffle.

Pass one scatters records into buckets with seeded hashes: the shard follows from the
document id and the number of shards alone (rendezvous hashing: the shard whose hash
with the id is largest, so one more shard takes records only into itself), and the
bucket inside the shard from a hash of id and text.  The number of buckets follows
from the measured total size, so that one bucket fits a memory target at any scale.
Pass two brings each bucket into one task's memory, shuffles it with Fisher-Yates from
a seed of its own and writes it; buckets in a row make a shard.

Law kept: ``key``.  Exchanging one record's text moves no other record.

Defined results: a null text has size 1 and no crc of its own (the crc of no bytes, 0);
a null id hashes like any value; records with equal id and text are interchangeable;
an empty table gives empty shards; all input columns are written, those named like
the shard columns are replaced.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

SHARDS = 8
BUCKET_BYTES = 16 << 20
SEED = 20_240_117


def record_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1).cast("bigint")


def shard_of(key: Column, n_shards: int, seed: int = SEED) -> Column:
    """Rendezvous hashing over shard numbers."""
    best = F.array_max(F.array(*[F.struct(F.xxhash64(F.lit(seed), key.cast("string"), F.lit(s)).alias("h"),
                                          F.lit(s).alias("s")) for s in range(n_shards)]))
    return best["s"].cast("int")


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A uniform permutation of 0..n-1."""
    order, draw = list(range(n)), random.Random(seed).random
    for i in range(n - 1, 0, -1):
        j = int(draw() * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


OWN = ("size", "text_crc32", "shard", "bucket", "place", "grown_shard")


def scatter(df: DataFrame, key: str = "doc_id", text: str = "text", n_shards: int = SHARDS,
            bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """Pass one: add size, crc, shard and bucket to every record."""
    total = df.select(F.sum(record_size(text))).first()[0] or 0
    buckets = max(1, -(-total // (n_shards * bucket_bytes)))
    k, t = F.col(f"`{key}`"), F.col(f"`{text}`")
    own = {c.lower() for c in OWN}
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c.lower() not in own],
        record_size(text).alias("size"), F.crc32(F.coalesce(t, F.lit("")).cast("binary")).alias("text_crc32"),
        shard_of(k, n_shards, seed).alias("shard"), shard_of(k, n_shards + 1, seed).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), k.cast("string"), t), F.lit(buckets)).cast("int").alias("bucket"))


def shuffle_buckets(scattered: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Pass two: Fisher-Yates inside every bucket; ``place`` is the position in the bucket."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in scattered.schema]
                          + [T.StructField("place", T.LongType())])

    def shuffled(group: pa.Table) -> pa.Table:
        # arrival order differs from run to run: fix it before drawing
        group = group.sort_by([(key, "ascending"), ("text_crc32", "ascending"), ("size", "ascending")])
        shard, bucket = group.column("shard")[0].as_py(), group.column("bucket")[0].as_py()
        order = fisher_yates(group.num_rows, hash((seed, shard, bucket)))
        place = pa.array(np.arange(group.num_rows, dtype=np.int64))
        return group.take(pa.array(order)).append_column("place", place)

    return scattered.groupBy("shard", "bucket").applyInArrow(shuffled, schema)


def write_shards(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", n_shards: int = SHARDS,
                 bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """Shuffle all records into shards written under ``path``; returns the written table.

    Rows lie in files by bucket, in shuffled order; ``slot`` (gapless in a shard) is the
    number of rows in earlier buckets of the shard plus the place in the bucket.
    """
    done = shuffle_buckets(scatter(df, key, text, n_shards, bucket_bytes, seed), key, seed)
    done.write.option("compression", "zstd").parquet(path)
    written = df.sparkSession.read.schema(done.schema).parquet(path)
    before = "_before"
    while before in [c.lower() for c in written.columns]:     # a name that the input does not use
        before += "_"
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket
    offsets = (written.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
               .select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before)))
    return (written.drop("slot").join(offsets, ["shard", "bucket"])
            .withColumn("slot", F.col(before) + F.col("place")).drop(before))
