"""Command line: the full load, any named query, the analytics report, the event stream.

    python -m starling load    --sf-dir /root/testdata/sf0.1 --warehouse /shared/wh [--lake /shared/lake]
    python -m starling query   monthly_premium --sf-dir DIR [--warehouse WH] [--show 20]
    python -m starling report  --warehouse WH --sf-dir DIR
    python -m starling stream  --source DIR|TOPIC [--brokers HOSTS] --log DIR --checkpoint DIR [--policy strict|lenient]
    python -m starling compact --log DIR [--counts DIR] [--policy strict|lenient] [--keep N]
    python -m starling publish --warehouse WH --database NAME
    python -m starling list

``--as-of YYYY-MM-DD`` sets the run's "today" (default 2001-12-31 for the test tables).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from starling.params import RunParams


def _params(args) -> RunParams:
    if not getattr(args, "as_of", None):
        return RunParams()
    d = dt.date.fromisoformat(args.as_of)
    return RunParams(as_of=d, load_ts=dt.datetime(d.year, d.month, d.day))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="starling")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p_load = sub.add_parser("load", help="build / extend the star schema (re-runnable)")
    p_query = sub.add_parser("query", help="run one named query")
    p_report = sub.add_parser("report", help="run every analytics query over a stored star schema")
    p_publish = sub.add_parser("publish", help="tables and views of a stored star schema in the session catalog")
    p_stream = sub.add_parser("stream", help="decode a topic directory into the event log")
    p_compact = sub.add_parser("compact", help="merge the micro-batches of an event log")
    sub.add_parser("list", help="list query names")
    for p in (p_load, p_query, p_report):
        p.add_argument("--sf-dir", required=p is not p_report)
        p.add_argument("--as-of")
        p.add_argument("--master", default=None)
    p_load.add_argument("--warehouse", required=True)
    p_load.add_argument("--lake")
    p_load.add_argument("--input-gb", type=float, help="size of the source tables: sizes shuffles for a cluster")
    p_load.add_argument("--cores", type=int, default=8, help="task slots of the cluster, with --input-gb")
    p_load.add_argument("--mirror", help="root of the mirror tables")
    p_query.add_argument("name")
    p_query.add_argument("--warehouse")
    p_query.add_argument("--show", type=int, default=20)
    p_report.add_argument("--warehouse", required=True)
    p_publish.add_argument("--warehouse", required=True)
    p_publish.add_argument("--database", required=True)
    p_publish.add_argument("--master", default=None)
    p_stream.add_argument("--source", required=True)
    p_stream.add_argument("--log", required=True)
    p_stream.add_argument("--checkpoint", required=True)
    p_stream.add_argument("--quarantine")
    p_stream.add_argument("--counts", help="folder of the counts per micro-batch (default: beside the log)")
    p_stream.add_argument("--brokers", help="read the Kafka topic --source from these brokers, not a folder")
    p_stream.add_argument("--batch-rows", type=int, help="messages per micro-batch (Kafka)")
    p_stream.add_argument("--batch-files", type=int, help="feed files per micro-batch (folder)")
    p_stream.add_argument("--follow", action="store_true", help="run for ever instead of reading what there is")
    p_stream.add_argument("--policy", choices=["strict", "lenient"], default="strict")
    p_stream.add_argument("--master", default=None)
    p_compact.add_argument("--log", required=True)
    p_compact.add_argument("--counts", help="folder of the counts per micro-batch (default: beside the log)")
    p_compact.add_argument("--policy", choices=["strict", "lenient"], default="strict")
    p_compact.add_argument("--keep", type=int, default=1, help="newest micro-batches that are not merged")
    p_compact.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from starling.plans import registry
    if args.cmd == "list":
        print("\n".join(registry.ALL))
        return 0

    from starling.session import build_session, cluster_conf
    sized = getattr(args, "input_gb", None)
    spark = build_session(args.master, conf=cluster_conf(int(sized * (1 << 30)), args.cores) if sized else None)
    if args.cmd == "load":
        from starling.plans import load
        from starling.sources import testbed
        params = _params(args)
        report = load.run(spark, testbed.domain(spark, args.sf_dir, params), args.warehouse, params,
                          lake_root=args.lake, mirror_root=args.mirror)
        print(json.dumps(report, default=str, indent=2))
    elif args.cmd == "query":
        params = _params(args)
        if args.warehouse:
            from starling.plans import load
            from starling.sources import testbed
            star = load.stored_star(spark, args.warehouse, params, testbed.domain(spark, args.sf_dir, params))
            df = registry.STAR_QUERIES[args.name](star)
            order = registry.order_columns(args.name)
            df = df.orderBy(*order) if order else df
        else:
            df = registry.run(spark, args.sf_dir, args.name, params, ordered=True)
        df.show(args.show, truncate=False)
    elif args.cmd == "report":
        from starling.plans import analytics, load
        from starling.sources import testbed
        params = _params(args)
        domain = testbed.domain(spark, args.sf_dir, params) if args.sf_dir else None
        star = load.stored_star(spark, args.warehouse, params, domain)
        for name in ["monthly_premium", "county_premium", "policy_type_dist", "claims_status",
                     "loss_ratio_as_written", "agent_top10", "payment_method", "late_by_frequency",
                     "age_band", "collections_as_written"]:
            print(f"== {name}")
            analytics.ordered(registry.STAR_QUERIES[name](star),
                              *registry.order_columns(name)).show(50, truncate=False)
    elif args.cmd == "publish":
        from starling.plans import catalog
        print(json.dumps(catalog.publish(spark, args.database, args.warehouse)))
    elif args.cmd == "compact":
        from starling.streaming import compaction, consumer
        sinks = consumer.Sinks(args.log, args.counts or f"{args.log.rstrip('/')}-counts")
        print(json.dumps(compaction.compact_all(spark, sinks, consumer.POLICIES[args.policy], args.keep)))
    elif args.cmd == "stream":
        from starling.streaming import consumer
        policy = consumer.POLICIES[args.policy].with_limits(rows=args.batch_rows, files=args.batch_files)
        sinks = consumer.Sinks(args.log, args.counts or f"{args.log.rstrip('/')}-counts", args.quarantine)
        if args.brokers:
            topic = consumer.kafka_topic(spark, policy, args.brokers, args.source)
        else:
            topic = consumer.folder_topic(spark, policy, args.source, args.checkpoint)
        query = consumer.start(topic, sinks, args.checkpoint, policy, available_now=not args.follow,
                               name=f"event_log_{args.policy}")
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        for r in consumer.totals(spark, sinks).collect():
            print(f"{r['stream_id']}: {r['received']} events received, {r['logged']} logged, {r['broken']} broken")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
