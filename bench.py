"""Benchmark: full star-schema load + every analytic query over the stored tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: sec}, "sf", ...}.
ETL stages are reported as ``etl_<table>``; queries run on the written tables
(the production path), each timed end to end including result collection.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starling.params import RunParams  # noqa: E402
from starling.plans import load, registry  # noqa: E402
from starling.session import build_session  # noqa: E402
from starling.sources import testbed  # noqa: E402

# queries over the stored star schema (the facts/dims themselves are the ETL stages)
SKIP = {"dim_date", "dim_policy_type", "dim_county", "dim_customer", "dim_agent", "fact_sales", "fact_claims",
        "fact_payments", "rows_with_valid_date", "hash_assigned_agent", "installment_schedule", "child_expansion",
        "dropped_dates", "new_rows_only", "sampled_rows"}
# full-size outputs: run to completion with a no-op sink instead of collecting
LARGE = {"installment_schedule", "child_expansion", "events_lenient", "events_strict", "sampled_rows",
         "sales_records"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    scratch = tempfile.mkdtemp(prefix="starling-bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          conf={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g"),
                                "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024)})
    params = RunParams()
    times: dict[str, float] = {}

    domain = testbed.domain(spark, sf_dir, params)
    t0 = time.time()
    report = load.run(spark, domain, os.path.join(scratch, "warehouse"), params, with_checks=False)
    for k, v in report["seconds"].items():
        times[f"etl_{k}"] = v
    times["etl_total"] = round(time.time() - t0, 3)

    star = load.stored_star(spark, os.path.join(scratch, "warehouse"), params, domain)
    for name, q in registry.STAR_QUERIES.items():
        if name in SKIP:
            continue
        t = time.time()
        df = q(star)
        if name in LARGE:
            df.write.format("noop").mode("overwrite").save()
        else:
            df.collect()
        times[name] = round(time.time() - t, 3)
    for name, q in registry.FEED_QUERIES.items():
        t = time.time()
        df = q(spark, sf_dir, params)
        if name in LARGE:
            df.write.format("noop").mode("overwrite").save()
        else:
            df.collect()
        times[name] = round(time.time() - t, 3)

    query_total = round(sum(v for k, v in times.items() if not k.startswith("etl_")), 3)
    out = {"metric": "etl_plus_queries_total_sec", "value": round(times["etl_total"] + query_total, 3),
           "unit": "sec", "queries": times, "sf": sf, "etl_sec": times["etl_total"], "query_sec": query_total,
           "n_queries": sum(1 for k in times if not k.startswith("etl_")), "cpus": cpus,
           "appended_rows": report.get("appended", {})}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
