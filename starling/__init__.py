"""starling: a PySpark-native policy/claims/payments star-schema engine.

Every transformation is a pure ``DataFrame -> DataFrame`` function built from
native Spark SQL expressions, so Catalyst prunes columns, pushes filters into
the Parquet scans and keeps the work inside whole-stage codegen.

Layout
------
``sources``    scans, tolerant reads, connectors, the test-table mapping
``functions``  column rules (bands, calendar parts, stable hashes, money)
``operators``  keys/anti/semi joins, checked broadcast, fan-out aggregation,
               schedule expansion, data-quality passes
``plans``      dimensions, facts, analytics queries, views, the full run
``sinks``      snapshot / append / partitioned writers, views
``streaming``  event decoding (strict and lenient) and the event-log stream
``oracle``     DuckDB SQL twins used by the correctness gate
"""

from starling.params import RunParams

__all__ = ["RunParams"]
