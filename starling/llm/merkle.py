"""Merkle manifest of a dataset: subroots per group, a root, and a proof for every row.

A row's leaf is the digest of its columns.  In a group the leaves ascend by key; every
``ARITY`` consecutive nodes become their digest until one node, the subroot, remains.
Subroots, ordered by group, likewise give the root.

Nested-struct rollup: a row's rank in its group is written in digits of base ``ARITY``.  A block
holds the rows that share all but the last ``digits`` of them; within it digit columns are
grouped away one after another, from the last one on, each time nesting the children in an
array of structs beside their node.  All these groupings run on one exchange, by block.  The
blocks' nodes are the rows of the next tier, rolled up alike, so that a row never holds more than
``ARITY ** digits`` leaves however large a group is.  Proofs come down the same way without
joins: a tier's blocks are put together with the paths of their nodes by a union that is
grouped by block, and a transform over the nested children followed by an explode
emits one path per child.

Ranks: rows are range-partitioned by group, key and leaf and numbered by their place in the
partition; counts per partition and group, one row each, give the offsets.  A row number of
the written leaves breaks ties, so that copies of one row can be split between partitions.

Defined results: a null value enters the digest as ``-``; a null key or group comes first;
rows with one key are ordered by their leaf, so equal rows are neighbouring leaves with a proof
each; an empty text is not a null one; an empty table gives no rows; columns that are not
named are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starling.llm.common import stage

ARITY = 8
DIGITS = 3       # of a rank, rolled up within one block
PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_of(values: list[Column]) -> Column:
    """Digest of a row's values: ``-`` for null, else byte count, colon and the value as text."""
    def entry(v):
        t = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
    return digest(F.concat(*[entry(v) for v in values]))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def number(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` (with a column ``g``) with their rank in the group, from 0, and the group's total.

    Also returns the greatest total.
    """
    by = [F.col(c).asc_nulls_first() for c in ["g", *order]]
    laid = stage(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                 .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "laid")
    # one row per partition and group in it
    counts = laid.groupBy("part", "g").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    group = Window.partitionBy("g")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage(counts.select("part", "g", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"),
                                 F.sum("n").over(group).alias("total")), "offsets")
    most = counts.agg(F.max("total")).first()[0] or 0
    placed = counts.select(F.col("part").alias("o_part"), F.col("g").alias("o_g"), "first", "skip", "total")
    found = laid.join(placed, (F.col("part") == F.col("o_part")) & F.col("g").eqNullSafe(F.col("o_g")))
    return found.select(*rows.columns, (F.col("skip") + F.col("at") - F.col("first")).alias("rank"), "total"), most


def power(n: int) -> Column:
    return F.lit(ARITY ** n).cast("long")


def rollup(nodes: DataFrame, digits: int, low: int) -> DataFrame:
    """(g, total, block, node, kids): ``digits`` rank digits of (g, total, rank, node, load) grouped away.

    ``low`` levels lie below these nodes.
    """
    def digit(k):
        return F.expr(f"(rank div {ARITY ** k}) % {ARITY}").cast("int")

    names = [f"d{k}" for k in range(digits)]
    rows = nodes.select("g", "total", F.expr(f"rank div {ARITY ** digits}").alias("block"),
                        *[digit(k).alias(names[k]) for k in range(digits)], "node", "load")
    rows = rows.repartition("g", "block").withColumnRenamed("load", "below")
    for k in range(digits):
        keys = ["g", "total", "block", *names[k + 1:]]
        kid = F.struct(F.col(names[k]).alias("d"), "node", "below")
        rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(kid)).alias("below"))
        joined = digest(F.array_join(F.col("below.node"), ""))
        # a level exists while more than one node remains below it
        node = F.when(F.col("total") > power(low + k), joined).otherwise(F.col("below.node")[0])
        rows = rows.select(*keys, node.alias("node"), "below")
    return rows.select("g", "total", "block", "node", F.col("below").alias("kids"))


def paths(blocks: DataFrame, digits: int, low: int) -> DataFrame:
    """(g, load, node, path, info) of every child nested in (g, total, block, kids, path, info)."""
    total = F.col("total")

    def entry(kids, i, k):
        left = F.array_join(F.transform(F.slice(kids, F.lit(1), i), lambda x: x["node"]), "")
        right = F.array_join(F.transform(F.slice(kids, i + 2, F.lit(ARITY)), lambda x: x["node"]), "")
        one = F.array(F.struct(left.alias("left"), right.alias("right")))
        return F.when(total > power(low + k), one).otherwise(F.array().cast(PATH))

    def below(last, k):
        def open_kids(y):
            return F.transform(y["below"], lambda x, i: F.struct(
                x["below"].alias("below"), *([x["node"].alias("node")] if last else []),
                F.concat(entry(y["below"], i, k), y["path"]).alias("path")))
        return open_kids

    rows = blocks.withColumn("found", F.array(F.struct(F.col("kids").alias("below"), "path")))
    for k in reversed(range(digits)):
        rows = rows.withColumn("found", F.flatten(F.transform("found", below(k == 0, k))))
    return (rows.select("g", "info", F.explode("found").alias("x"))
            .select("g", F.col("x.below").alias("load"), F.col("x.node").alias("node"), F.col("x.path").alias("path"), "info"))


def prove(nodes: DataFrame, most: int, digits: int, above: Callable[[DataFrame], DataFrame], low: int = 0) -> DataFrame:
    """(g, load, node, path, info) of (g, total, rank, node, load) rows.

    ``above`` gets each group's top (g, node) and returns (g, path, info), which end every path.
    """
    blocks = stage(rollup(nodes, digits, low), "blocks")
    if most <= ARITY ** digits:
        # one block per group
        up = above(blocks.select("g", "node")).withColumn("block", F.lit(0).cast("long"))
    else:
        nodes_above = blocks.select("g", "total", F.col("block").alias("rank"), "node", F.struct("block").alias("load"))
        up = prove(nodes_above, -(-most // ARITY ** digits), digits, above, low + digits)
        up = up.select("g", F.col("load.block").alias("block"), "path", "info")
    types = {f.name: f.dataType for f in [*blocks.schema, *up.schema]}

    def missing(*names):
        return [F.lit(None).cast(types[c]).alias(c) for c in names]

    both = (blocks.select("g", "block", "total", "kids", *missing("path", "info"))
            .unionByName(up.select("g", "block", *missing("total", "kids"), "path", "info")))
    whole = both.groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c)
                                            for c in ("total", "kids", "path", "info")])
    return paths(whole, digits, low)


def manifest(df: DataFrame, columns: list[str], key: str = "doc_id", group: str = "lang", digits: int = DIGITS,
             altered: dict[str, Column] | None = None) -> DataFrame:
    """(key, leaf, altered_leaf, path, subroot, root) of every row.

    ``altered`` gives columns of rows as found now, for a check against the manifest
    (the leaf itself if not given).  ``fold(altered_leaf, path)`` equals the root if and only if
    nothing changed.
    """
    if not columns:
        raise ValueError("columns: at least one")
    now = altered or {}
    leaf = leaf_of([F.col(f"`{c}`") for c in columns])
    found = leaf_of([now.get(c, F.col(f"`{c}`")) for c in columns]) if now else leaf
    leaves = stage(df.select(F.col(f"`{group}`").alias("g"), F.col(f"`{key}`").alias("k"), leaf.alias("node"),
                             found.alias("altered_leaf"), F.monotonically_increasing_id().alias("row")), "leaves")
    numbered, most = number(leaves, ["k", "node", "row"])
    nodes = numbered.select("g", "total", "rank", "node", F.struct("k", "altered_leaf").alias("load"))

    def to_root(tops: DataFrame) -> DataFrame:
        tops = tops.select(F.lit(0).alias("g"), F.col("g").alias("name"), "node")
        ordered, n_groups = number(tops, ["name"])
        nodes = ordered.select("g", "total", "rank", "node", F.struct("name").alias("load"))

        def end(root):
            return root.select("g", F.array().cast(PATH).alias("path"), F.struct(F.col("node").alias("root")).alias("info"))

        return prove(nodes, n_groups, digits, end).select(
            F.col("load.name").alias("g"), "path",
            F.struct(F.col("node").alias("subroot"), F.col("info.root").alias("root")).alias("info"))

    return prove(nodes, most, digits, to_root).select(
        F.col("load.k").alias(key), F.col("node").alias("leaf"), F.col("load.altered_leaf").alias("altered_leaf"),
        "path", F.col("info.subroot").alias("subroot"), F.col("info.root").alias("root"))
