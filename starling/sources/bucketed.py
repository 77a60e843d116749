"""Domain tables stored bucketed by their join key, so that large joins need no exchange.

Policies and claims are both bucketed and sorted by ``policy_id``: a join on it reads
bucket i of one beside bucket i of the other.  The bucketing lives in the session catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEYS = {"policies": "policy_id", "claims": "policy_id"}


def store(spark: SparkSession, database: str, root: str, domain: dict[str, DataFrame], buckets: int) -> list[str]:
    """Write the domain's large tables bucketed (once; a table that exists is left as it is)."""
    root = root.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root}/_catalog'")
    written = []
    for name, key in KEYS.items():
        if name not in domain or spark.catalog.tableExists(f"{database}.{name}"):
            continue
        # one task per bucket and one file each, sorted by the key
        (domain[name].repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
         .format("parquet").option("path", f"{root}/{name}").saveAsTable(f"{database}.{name}"))
        written.append(name)
    return written


def stored(spark: SparkSession, database: str, domain: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The domain with its stored tables in place of the given ones."""
    found = {name: spark.table(f"{database}.{name}") for name in KEYS if spark.catalog.tableExists(f"{database}.{name}")}
    return {**domain, **found}
