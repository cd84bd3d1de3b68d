"""Incremental ingestion: files arriving in two rounds are each loaded once."""

import os
import tempfile

from tallyrisk.sources.fixtures import bronze_frames
from tallyrisk.sources.store import write_csv
from tallyrisk.streaming import start_ingest
from oracle.registry import AS_OF


def test_incremental_ingest(spark, small_dir):
    root = tempfile.mkdtemp(prefix="tallyrisk-stream-")
    landing, target, ckpt = (os.path.join(root, p) for p in ("landing", "bronze", "ckpt"))
    txns = bronze_frames(spark, small_dir)["bronze_transactions"]()
    first, second = txns.filter("transaction_id % 2 = 0"), txns.filter("transaction_id % 2 = 1")
    write_csv(first, os.path.join(landing, "round1"))
    q = start_ingest(spark, landing + "/*", "bronze_transactions", target, ckpt, available_now=True)
    q.awaitTermination(300)
    assert spark.read.parquet(target).count() == first.count()
    write_csv(second, os.path.join(landing, "round2"))
    q = start_ingest(spark, landing + "/*", "bronze_transactions", target, ckpt, available_now=True)
    q.awaitTermination(300)
    stored = spark.read.parquet(target)
    assert stored.count() == txns.count()
    assert stored.select(*txns.columns).exceptAll(txns).count() == 0


def test_ingest_all_entities_then_layer_runs(spark, small_dir):
    from tallyrisk.plans import runs
    from tallyrisk.schemas import FILE_TO_TABLE
    from tallyrisk.sources.store import LayerStore
    from tallyrisk.streaming import start_ingest_all
    root = tempfile.mkdtemp(prefix="tallyrisk-stream-all-")
    frames = bronze_frames(spark, small_dir)
    for file_name, table in FILE_TO_TABLE.items():
        write_csv(frames[table](), os.path.join(root, "landing", file_name.rsplit(".", 1)[0], "batch1"))
    store_root = os.path.join(root, "store")
    qs = start_ingest_all(spark, os.path.join(root, "landing"), store_root, os.path.join(root, "ckpt"),
                          available_now=True)
    for q in qs.values():
        q.awaitTermination(300)
    store = LayerStore(spark, store_root)
    for table in FILE_TO_TABLE.values():
        assert spark.read.parquet(runs.bronze_path(store, table)).count() == frames[table]().count()
    counts = {r.table_name: r.row_count for r in runs.run_silver(spark, store, AS_OF, version="v1").collect()}
    assert counts["silver_transactions"] == frames["bronze_transactions"]().count()
