"""Ordered layer runs with published tables (the job entry points).

``run_bronze`` (H01): raw files -> key-checked append to the bronze tables.
``run_silver`` (H10): bronze -> silver_customers, silver_accounts,
silver_transactions, each published as a new version, then verified.
``run_gold`` (H11): silver -> gold_customer_360, gold_fraud_features,
gold_daily_fraud_summary, then verified.

Each layer reads the *written* tables of the layer below, so lineage is
cut at every layer boundary: a lost executor only recomputes from the last
written table, and the feature plan starts from a plain scan.  A table
that comes out empty is not published (the previous version stays).  The tables
of a run are published by one manifest at its end: readers never see some of
them new and some old, and after a run that died all are as before.

    python -m tallyrisk.plans.runs --raw RAW_DIR --store STORE_ROOT [--as-of TS]
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.operators import quality
from tallyrisk.operators.sequence import assign_buckets
from tallyrisk.plans import gold, silver
from tallyrisk.schemas import BRONZE_TABLES, GOLD_TABLES, SILVER_TABLES
from tallyrisk.sources.loads import Loads
from tallyrisk.sources.raw_files import Appended, append_checked, load_time, new_load_id, read_entity_files
from tallyrisk.sources.store import LayerStore, Run

log = logging.getLogger(__name__)


def new_version(as_of) -> str:
    """Version id ordered by as_of, then by run time: a rerun never overwrites
    the version readers currently use."""
    as_of_part = dt.datetime.fromisoformat(str(as_of)).strftime("%Y%m%d_%H%M%S")
    return f"{as_of_part}_{dt.datetime.now(dt.timezone.utc).strftime('%Y%m%d%H%M%S%f')}"


def bronze_path(store: LayerStore, table: str) -> str:
    return f"{store.root}/{table}/current"


def run_bronze(spark: SparkSession, raw_dir: str, store: LayerStore, mode: str = "fail",
               load_id: str | None = None, loaded_at: str | None = None) -> dict[str, Appended]:
    """Load every present raw file; returns rows appended (and rejected, by reason) per table.

    Every run is a load of its own: one id, one time, taken from the clock at its start.  A run that died
    is finished by another one with the same ``load_id``: tables that have the load are left alone.
    """
    load_id, loaded_at = load_id or new_load_id(), loaded_at or load_time()
    return {table: append_checked(df, bronze_path(store, table), table, mode=mode, load_id=load_id)
            for table, df in read_entity_files(spark, raw_dir, loaded_at, load_id).items()}


def read_bronze(spark: SparkSession, store: LayerStore) -> dict[str, DataFrame]:
    return {t: Loads(spark, bronze_path(store, t)).read() for t in BRONZE_TABLES}


DAY_BUCKET = "_seq_bucket"
REJECTED = "gold_rejected_transactions"


def run_silver(spark: SparkSession, store: LayerStore, as_of, version: str | None = None,
               buckets: int | None = None, rows_per_bucket: int | None = 2_000_000, run: Run | None = None) -> DataFrame:
    """Customers, accounts, then transactions enriched from the written pair, published together.

    ``buckets``: publish the transactions bucketed on (customer_id, time
    bucket) into that many buckets (one file each).  The time bucket is stored
    as a non-NULL column: the day, or a finer width for the largest customers
    (:func:`tallyrisk.operators.sequence.assign_buckets`), NULL times last.
    The gold run then reads the rows co-located and skips its full-width
    shuffle.  Otherwise the transactions are partitioned by transaction date.

    ``run``: the tables become part of that run, to be published with others.
    Returns the counts of the written tables (:func:`verify`).
    """
    if run is None:
        with store.run(version or new_version(as_of)) as own:
            return run_silver(spark, store, as_of, buckets=buckets, rows_per_bucket=rows_per_bucket, run=own)
    # One state of every bronze table for all three, kept in the manifest.
    run.sources = {t: Loads(spark, bronze_path(store, t)).state().version for t in BRONZE_TABLES}
    b = {t: Loads(spark, bronze_path(store, t)).read(v or None) for t, v in run.sources.items()}
    run.publish("silver_customers", silver.silver_customers(
        b["bronze_customers"], b["bronze_interactions"], b["bronze_fraud_reports"], b["bronze_accounts"], as_of,
        matched="_matched"), observe={"matched_rows": F.count_if("_matched")}, hidden=("_matched",))
    run.publish("silver_accounts", silver.silver_accounts(b["bronze_accounts"], b["bronze_transactions"], as_of))
    log.info("silver_customers: %s rows matched with account totals", run.facts("silver_customers").get("matched_rows"))
    txns = silver.silver_transactions(
        b["bronze_transactions"], run.read("silver_customers"), run.read("silver_accounts"), as_of)
    if buckets:
        seq = assign_buckets(txns, "customer_id", "transaction_timestamp", "transaction_id", 24, rows_per_bucket)
        run.publish("silver_transactions", seq.withColumnRenamed("_bucket", DAY_BUCKET),
                    bucket_by=(buckets, ["customer_id", DAY_BUCKET]),
                    sort_within=["customer_id", DAY_BUCKET, "transaction_timestamp"])
    else:
        run.publish("silver_transactions", txns, partition_by=["transaction_date"],
                    sort_within=["transaction_date", "customer_id", "transaction_timestamp"])
    return verify(spark, run, SILVER_TABLES)


def run_gold(spark: SparkSession, store: LayerStore, as_of, version: str | None = None,
             bucket_hours: int = 24, run: Run | None = None) -> DataFrame:
    """Customer profile, per-transaction features, daily summary, published together; transactions
    without a customer are published as ``gold_rejected_transactions`` with the reason."""
    if run is None:
        with store.run(version or new_version(as_of)) as own:
            return run_gold(spark, store, as_of, bucket_hours=bucket_hours, run=own)
    c, a, t = (run.read(n) for n in SILVER_TABLES)
    bucketed = (run.bucketing("silver_transactions") or (0, []))[1] == ["customer_id", DAY_BUCKET]
    run.publish("gold_customer_360", gold.customer_360(c, t, as_of))
    features = (gold.fraud_features(t, a, as_of, bucket_col=DAY_BUCKET, prehashed=True) if bucketed
                else gold.fraud_features(t, a, as_of, bucket_hours=bucket_hours))
    run.publish("gold_fraud_features", features, sort_within=["transaction_timestamp"])
    run.publish(REJECTED, quality.rejected_feature_rows(t))
    run.publish("gold_daily_fraud_summary", gold.daily_fraud_summary(t, as_of))
    return verify(spark, run, GOLD_TABLES)


def verify(spark: SparkSession, store: LayerStore | Run, names: list[str]) -> DataFrame:
    """Row counts of the tables as observed by the tasks that wrote them (no table is read)."""
    rows = [(n, store.facts(n).get("rows")) for n in names]
    if any(count is None for _, count in rows):
        return quality.row_counts({n: store.read(n) for n in names}, names)
    return spark.createDataFrame(rows, "table_name string, row_count long")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--raw", required=True, help="folder with the raw entity CSV files")
    p.add_argument("--store", required=True, help="shared root folder of the layer tables")
    p.add_argument("--as-of", help="the instant that ages, tenures and windows count from; the clock at the start if not given")
    p.add_argument("--keep", type=int, default=0, help="published versions of a table that stay (0: all)")
    p.add_argument("--mode", default="fail", choices=["fail", "skip"])
    p.add_argument("--input-bytes", type=int, default=0, help="approximate input volume, for partition sizing")
    p.add_argument("--executors", type=int, default=0)
    p.add_argument("--executor-cores", type=int, default=4)
    p.add_argument("--bucket-hours", type=int, default=24, help="time bucket of the sequence features")
    p.add_argument("--buckets", type=int, default=0,
                   help="buckets of the silver transactions (by default about a gigabyte each, from --input-bytes)")
    args = p.parse_args(argv)
    from tallyrisk.session import build_session, silver_buckets, sizing_conf
    extra = (sizing_conf(args.input_bytes, args.executor_cores, args.executors)
             if args.input_bytes and args.executors else None)
    spark = build_session(master=None, extra=extra)
    as_of = args.as_of or load_time()
    store = LayerStore(spark, args.store, args.keep)
    for table, n in run_bronze(spark, args.raw, store, args.mode).items():
        log.warning("%s: %d rows appended, rejected %s", table, n, n.rejects)
    buckets = args.buckets or (silver_buckets(args.input_bytes) if args.input_bytes else None)
    with store.run(new_version(as_of)) as run:  # both layers change at once
        run_silver(spark, store, as_of, buckets=buckets, run=run).show()
        run_gold(spark, store, as_of, bucket_hours=args.bucket_hours, run=run).show()


if __name__ == "__main__":
    main()
