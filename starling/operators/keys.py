"""Key operators: new-row filter, valid/dropped split, surrogate keys, dense index,
hash-based partner assignment.

None of these funnels a table through one task, and none runs a job while it is
built: the dense index numbers rows in buckets whose bounds are a bounded sample of the
keys, and partner assignment is an equi-join on a hashed slot number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from starling.functions.hashing import hash32
from starling.operators.lookup import checked_broadcast

SPLITS = 256    # buckets of a dense index


def only_new_rows(incoming: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """Rows of ``incoming`` whose key is not yet in ``existing`` (null-safe).

    Duplicates inside the batch are kept (as in the reference); a missing
    target (``None``) keeps every row.
    """
    if existing is None:
        return incoming
    keys = existing.select(F.col(key).alias("_existing_key"))
    return incoming.join(keys, incoming[key].eqNullSafe(keys["_existing_key"]), "left_anti")


def split_by_reference(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None):
    """(kept, dropped): rows whose key is / is not present in ``ref`` (semi / anti join)."""
    ref_key = ref_key or key
    r = ref.select(F.col(ref_key).alias("_ref_key")).distinct()
    cond = df[key] == r["_ref_key"]
    return df.join(r, cond, "left_semi"), df.join(r, cond, "left_anti")


def keep_observed(df: DataFrame, ref: DataFrame, key: str, observation: Observation | None) -> DataFrame:
    """Rows whose key is in ``ref``; ``observation`` counts rows read and dropped while they are written.

    ``ref`` holds each key once.  Counts of tasks that run again after a lost executor can be
    added twice where a shuffle follows; compare them with the rows written.
    """
    r = ref.select(F.col(key).alias("_ref_key"), F.lit(True).alias("_known"))
    marked = df.join(r, df[key] == r["_ref_key"], "left")
    if observation is not None:
        marked = marked.observe(observation, F.count(F.lit(1)).alias("read"),
                                F.count_if(F.col("_known").isNull()).alias("dropped"))
    return marked.where("_known").drop("_ref_key", "_known")


def dense_index(df: DataFrame, order_cols: list[str], name: str = "_idx", splits: int = SPLITS) -> DataFrame:
    """Add a 0-based position of each row in the global order of ``order_cols`` (one plan, no jobs).

    Splitters come from the data: keys are dealt to ``splits`` hash slots and each slot gives its
    key with the smallest hash, a sample that is uniform over distinct keys, the same in
    every evaluation, and at most ``splits`` rows.  A key's bucket is the number of splitters not
    above it, so that buckets are ranges of about equal size.  The position is the number
    of rows in earlier buckets (a window over one row per bucket) plus the rank in the bucket.

    Rows with equal keys share a bucket and are numbered in any order; null keys come first.
    """
    own = df.columns
    key = F.struct(*[F.col(f"`{c}`") for c in order_cols])
    drawn = F.xxhash64(F.lit("splitter"), *[F.col(f"`{c}`") for c in order_cols])
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)], key.alias("k"), drawn.alias("h"))
    sample = rows.groupBy(F.pmod("h", F.lit(splits)).alias("slot")).agg(F.min_by("k", "h").alias("k"))
    splitters = sample.select(F.sort_array(F.collect_list("k")).alias("ks")).scalar()
    placed = rows.withColumn("ks", splitters).withColumn("bucket", F.size(F.filter("ks", lambda s: s <= F.col("k"))))
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # at most splits + 1 rows
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("k"))
    found = placed.withColumn("rank", rank).join(F.broadcast(offsets), "bucket")
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(own)],
                        (F.col("skip") + F.col("rank") - 1).alias(name))


def assign_serial_keys(candidates: DataFrame, name_col: str, id_col: str,
                       existing: DataFrame | None = None, out_name: str | None = None) -> DataFrame:
    """SERIAL-style surrogate keys for new dimension members.

    Distinct non-null names not already present get ``max(existing id) + 1 ...``
    in name order.  Returns only the new members (append them to the dimension).
    """
    out_name = out_name or name_col
    names = candidates.where(F.col(name_col).isNotNull()).select(F.col(name_col).alias(out_name)).distinct()
    if existing is not None:
        names = names.join(existing.select(out_name), on=out_name, how="left_anti")
        base = existing.select(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()
    else:
        base = F.lit(0).cast("long")
    indexed = dense_index(names, [out_name])
    return indexed.select((base + F.col("_idx") + 1).cast("int").alias(id_col), out_name)


def assign_partner(df: DataFrame, partners: DataFrame, partner_key: str, row_key: str,
                   salt: str, out_col: str, max_broadcast_rows: int | None = None) -> DataFrame:
    """Give every row one partner, chosen uniformly and reproducibly by hashing the row key.

    Partners are numbered 0..n-1 in key order (dense_index); a row gets slot
    ``hash32(salt, row_key) mod n`` and is equi-joined to that slot.  The
    partner table is broadcast only if its checked row count allows; otherwise
    the join shuffles on the slot (uniform, so no hot slot).
    """
    indexed = dense_index(partners.select(partner_key).distinct(), [partner_key], "_slot")
    n = partners.select(partner_key).distinct().select(F.count(F.lit(1))).scalar()
    slot = F.when(n > 0, F.pmod(hash32(salt, row_key), n))
    side = checked_broadcast(indexed.select("_slot", F.col(partner_key).alias(out_col)), max_broadcast_rows)
    return df.withColumn("_slot", slot).join(side, "_slot", "left").drop("_slot")
