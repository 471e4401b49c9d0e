"""Run one job of a lakehouse folder.

    python -m tidemark bronze    --root /lake --servers broker:9092 --prefix shop
    python -m tidemark silver    --root /lake            (dim, history, fact, agg likewise)
    python -m tidemark agg       --root /lake --start next
    python -m tidemark mart      --root /lake --name mart_daily_orders
    python -m tidemark enriched  --root /lake
    python -m tidemark reconcile --root /lake
    python -m tidemark validate  --root /lake --name fact_orders

Streaming jobs run until stopped, or with ``--once`` work off what is there. The
exit code of ``validate`` is 0 (passed), 1 (failed) or 2 (no such table).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import expectations
from tidemark.operators.reconcile import daily_counts, reconcile
from tidemark.session import build_session
from tidemark.sources.bronze import CdcSource
from tidemark.sources.reports import exit_code, write_report
from tidemark.sources.state import TableMissing
from tidemark.streaming.jobs import Lakehouse

SUITES = {
    "silver_customers": ("silver", expectations.silver_customers_suite),
    "fact_orders": ("fact", expectations.fact_orders_suite),
    "agg_orders_daily": ("agg", expectations.agg_orders_daily_suite),
}


def attend(query: StreamingQuery) -> int:
    """Wait for a stream; Ctrl-C ends it after the micro-batch in hand."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()
    return 0


def validate(house: Lakehouse, name: str) -> int:
    attribute, suite = SUITES[name]
    table = getattr(house, attribute)
    if not table.exists():
        raise TableMissing(table.root)
    success, folder = write_report(suite(), table.read(), f"{house.root}/quality")
    print(f"{name}: {'passed' if success else 'failed'}, report in {folder}")
    return exit_code(success)


def show_reconciliation(house: Lakehouse) -> int:
    fact, counts = house.fact.read(), house.agg.read()
    print(f"fact rows {fact.count()}, count rows {counts.count()}; differences:")
    reconcile(fact, counts).show(truncate=False)
    daily_counts(fact).orderBy("event_date", "order_status").show(truncate=False)
    counts.orderBy("event_date", "order_status").show(truncate=False)
    return 0


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser("tidemark")
    parser.add_argument("job", choices=(
        "bronze", "silver", "dim", "history", "fact", "agg", "seed", "mart", "enriched", "reconcile", "validate",
    ))
    parser.add_argument("--root", required=True, help="absolute folder of the lakehouse")
    parser.add_argument("--prefix", default="shop", help="first part of the topic names")
    parser.add_argument("--tz", default="UTC", help="zone whose calendar day dates an order")
    parser.add_argument("--buckets", type=int, default=1024)
    parser.add_argument("--guard", choices=("order", "event_time", "none"), default="order")
    parser.add_argument("--once", action="store_true")
    parser.add_argument("--servers", help="brokers; without them --landing is read")
    parser.add_argument("--landing", help="folder of Kafka-shaped Parquet files")
    parser.add_argument("--start", choices=("snapshot", "next"), default="snapshot")
    parser.add_argument("--name", help="mart or table")
    parser.add_argument("--register", help="name under which a mart is registered")
    parser.add_argument("--max-offsets", default="5000000", help="Kafka offsets of one micro-batch")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(argv)
    house = Lakehouse(
        build_session(f"tidemark-{args.job}"), args.root, args.prefix, args.tz, args.buckets, None if args.guard == "none" else args.guard,
    )
    if args.job == "bronze":
        paced = {"maxOffsetsPerTrigger": args.max_offsets}
        source = CdcSource("kafka", args.prefix, servers=args.servers, options=paced) if args.servers else CdcSource(
            "files", args.prefix, path=args.landing)
        return attend(house.start_bronze(source, args.once))
    if args.job in ("silver", "dim", "history", "fact"):
        return attend(getattr(house, f"start_{args.job}")(args.once))
    if args.job == "agg":
        return attend(house.start_agg(args.once, args.start))
    if args.job == "seed":
        house.seed_agg()
    elif args.job == "mart":
        house.build_mart(args.name or "mart_daily_orders", args.register)
    elif args.job == "enriched":
        house.backfill_enriched()
        print("rows", house.enriched.read().count())
    elif args.job == "reconcile":
        return show_reconciliation(house)
    else:
        try:
            return validate(house, args.name or "fact_orders")
        except TableMissing as missing:
            print(f"no table at {missing}")
            return missing.exit_code
    return 0


if __name__ == "__main__":
    sys.exit(main())
