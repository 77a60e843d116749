"""Mirror tables: append-only copies of facts under a schema contract, visible load by load.

Layout, under one mirror root:

    {root}/{table}/rows/load={load id}/*.parquet    the rows of one load
    {root}/{table}/loads/load={load id}/*.json      its manifest, written last

A reader takes the rows of loads that have a manifest, so a load that broke off is not seen at
all, and a load that is repeated under its id replaces its own rows.  A contract says
which frames may be appended: exact (the declared columns and no others) or additive (new
columns may come, as nullable ones; rows of earlier loads hold null there).  The table's
columns at any time are those of its newest manifest, so reading needs no file footers.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.operators.keys import only_new_rows
from starling.sources.files import path_exists

MANIFEST = T.StructType([T.StructField("row_count", T.LongType()), T.StructField("table_schema", T.StringType()),
                         T.StructField("sequence", T.LongType()), T.StructField("load", T.StringType())])


class SchemaRefused(ValueError):
    """A frame's columns break the mirror table's contract."""


@dataclass(frozen=True)
class Contract:
    schema: T.StructType
    additive: bool = False

    def accept(self, got: T.StructType, current: T.StructType) -> T.StructType:
        """The table's columns after an append of a frame with the columns ``got``."""
        types = {f.name: f.dataType for f in got.fields}
        missing = [f.name for f in self.schema.fields if f.name not in types]
        known = {f.name: f.dataType for f in current.fields}
        changed = [n for n, t in types.items() if n in known and known[n] != t]
        added = [f for f in got.fields if f.name not in known]
        if missing or changed or (added and not self.additive):
            raise SchemaRefused(f"missing {missing}, changed {changed}, added {[f.name for f in added]}; "
                                f"the contract is {'additive' if self.additive else 'exact'}")
        return T.StructType([*current.fields, *[T.StructField(f.name, f.dataType, True) for f in added]])


class Mirror:
    def __init__(self, spark: SparkSession, root: str, contracts: dict[str, Contract]):
        self.spark, self.root, self.contracts = spark, root.rstrip("/"), contracts

    def _path(self, name: str, part: str) -> str:
        return f"{self.root}/{name}/{part}"

    def loads(self, name: str) -> DataFrame:
        """One row per load that is visible."""
        path = self._path(name, "loads")
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).json(path)

    def state(self, name: str) -> tuple[T.StructType, int, int]:
        """The table's columns, its visible rows and the next load's sequence number."""
        loads = self.loads(name)
        last = loads.orderBy(F.desc("sequence")).limit(1).collect()
        if not last:
            return self.contracts[name].schema, 0, 0
        rows = loads.agg(F.sum("row_count")).first()[0]
        return T.StructType.fromJson(json.loads(last[0]["table_schema"])), rows, last[0]["sequence"] + 1

    def read(self, name: str) -> DataFrame:
        """All visible rows, in the table's present columns."""
        schema, _, _ = self.state(name)
        path = self._path(name, "rows")
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())])).parquet(path)
        # one row per load: prunes the folders of loads without a manifest
        seen = F.broadcast(self.loads(name).select("load"))
        return rows.join(seen, "load", "left_semi").select(*[f.name for f in schema.fields])

    def append(self, name: str, df: DataFrame, load_id: str) -> int:
        """Append a frame as one load; returns its rows.  Nothing is written if the contract refuses it."""
        current, _, sequence = self.state(name)
        schema = self.contracts[name].accept(df.schema, current)
        path = f"{self._path(name, 'rows')}/load={load_id}"
        df.write.mode("overwrite").parquet(path)
        n = self.spark.read.schema(df.schema).parquet(path).count()
        manifest = self.spark.createDataFrame([(n, json.dumps(schema.jsonValue()), sequence)], T.StructType(MANIFEST.fields[:3]))
        manifest.coalesce(1).write.mode("overwrite").json(f"{self._path(name, 'loads')}/load={load_id}")
        return n

    def follow(self, name: str, stored: DataFrame, batch: DataFrame | None, key: str, load_id: str) -> int:
        """Bring the mirror up to a stored table: ``batch`` is what this run added to it, if known.

        Where mirror and batch do not make up the table (an earlier mirror step broke off), the
        rows whose keys the mirror lacks are appended instead.
        """
        _, visible, _ = self.state(name)
        total = stored.count()      # from file footers
        if batch is None or visible + batch.count() != total:
            batch = stored if not visible else only_new_rows(stored, self.read(name).select(key), key)
            if visible == total:
                return 0
        if batch.isEmpty():
            return 0
        return self.append(name, batch, load_id)
