"""Raw file path: CSV written and read back, missing-value tokens, keyed append."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tallyrisk.schemas import FILE_TO_TABLE, RAW_SCHEMAS
from tallyrisk.sources.fixtures import bronze_frames
from tallyrisk.sources.raw_files import (
    RAW, REASONS, DuplicateKeyError, append_checked, read_entity_files, read_raw_csv, rejects_path, scan_raw_csv,
    with_lineage,
)
from tallyrisk.sources.store import LayerStore, write_csv


@pytest.fixture(scope="module")
def raw_dir(spark, small_dir):
    root = tempfile.mkdtemp(prefix="tallyrisk-raw-")
    frames = bronze_frames(spark, small_dir)
    for file_name, table in FILE_TO_TABLE.items():
        write_csv(frames[table]().coalesce(1), os.path.join(root, file_name))
    return root, frames


def test_round_trip(spark, raw_dir):
    root, frames = raw_dir
    loaded = read_entity_files(spark, root, batch_id="b1")
    assert set(loaded) == set(FILE_TO_TABLE.values())
    for table, df in loaded.items():
        src = frames[table]()
        assert df.count() == src.count()
        assert df.columns == src.columns + ["loaded_at", "source_file", "batch_id", REASONS, RAW]
        assert df.filter(F.size(REASONS) > 0).count() == 0
        cols = src.columns
        assert df.select(*cols).exceptAll(src).count() == 0
    names = {r[0] for r in loaded["bronze_accounts"].select("source_file").distinct().collect()}
    assert names and all(n.endswith(".csv") or n.startswith("part-") for n in names)


def test_missing_file_is_skipped(spark):
    empty = tempfile.mkdtemp(prefix="tallyrisk-empty-")
    assert read_entity_files(spark, empty) == {}


def _customers(path, *lines):
    header = ",".join(f.name for f in RAW_SCHEMAS["bronze_customers"].fields)
    with open(path, "w") as fh:
        fh.write("\n".join([header, *lines]) + "\n")


def test_tokens_and_leading_zeros(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tallyrisk-csv-"), "c.csv")
    _customers(path, "1,Ann,Lee,a@x,1,addr,Town,NY,01234,1980-01-02,NA,100.50,None,2010-01-01,m,Retail,High,"
                     "Verified,2024-01-01 10:00:00",
               "2,Bob,Ray,b@x,2,addr,Town,NY,00077,,Nurse,,700.0,2010-01-01,m,Retail,Low,,")
    rows = {r.customer_id: r for r in read_raw_csv(spark, path, RAW_SCHEMAS["bronze_customers"]).collect()}
    assert rows[1].zip_code == "01234" and rows[2].zip_code == "00077"
    assert rows[1].occupation is None and rows[1].credit_score is None
    assert float(rows[1].income) == 100.5 and rows[2].income is None
    assert rows[2].date_of_birth is None and rows[2].kyc_status is None and rows[2].credit_score == 700


def test_the_sources_dialect_loses_nothing(spark):
    """Whole numbers as floats, doubled quotes, line breaks; what does not parse is rejected with its texts."""
    path = os.path.join(tempfile.mkdtemp(prefix="tallyrisk-csv-"), "i.csv")
    header = ",".join(f.name for f in RAW_SCHEMAS["bronze_interactions"].fields)
    with open(path, "w") as fh:
        fh.write(header + "\n"
                 '1,10,complaint,Phone,7.0,2024-01-01 10:00:00,12.0,"said ""hi"", left",Resolved,4.0\n'
                 '2,10,complaint,Phone,7,2024-01-01 10:00:00,12,"two\nlines",Resolved,\n'
                 "3,10,complaint,Phone,7,2024-01-01 10:00:00,12,plain,Resolved,4.5\n"
                 "4,10,complaint,Phone,7,yesterday,12,plain,Resolved,x\n"
                 "5,10,too,short\n"
                 "6,10,complaint,Phone,7,2024-01-01 10:00:00,12,plain,Resolved,5\n")
    schema = RAW_SCHEMAS["bronze_interactions"]
    rows = {r.interaction_id: r for r in read_raw_csv(spark, path, schema).collect()}
    assert set(rows) == {1, 2, 6}
    assert rows[1].notes == 'said "hi", left' and rows[1].satisfaction_score == 4 and rows[1].agent_id == 7
    assert rows[2].notes == "two\nlines" and rows[2].outcome == "Resolved" and rows[2].satisfaction_score is None
    bad = {r[RAW]["interaction_id"]: r for r in scan_raw_csv(spark, path, schema).filter(F.size(REASONS) > 0).collect()}
    assert bad["3"][REASONS] == ["satisfaction_score: not int"]
    assert bad["4"][REASONS] == ["date_time: not timestamp_ntz", "satisfaction_score: not int"]
    assert bad["4"][RAW]["date_time"] == "yesterday" and bad["5"][REASONS] == ["malformed row"]


def test_rejects_are_stored_and_counted(spark):
    root = tempfile.mkdtemp(prefix="tallyrisk-rejects-")
    _customers(os.path.join(root, "crm_customers.csv"),
               "1,Ann,Lee,a@x,1,addr,Town,NY,01234,1980-01-02,NA,100.50,None,2010-01-01,m,Retail,High,V,2024-01-01 10:00:00",
               "2,Bob,Ray,b@x,2,addr,Town,NY,00077,not-a-date,Nurse,,700,2010-01-01,m,Retail,Low,,",
               ",Cy,Ray,b@x,2,addr,Town,NY,00077,,Nurse,,700,2010-01-01,m,Retail,Low,,",
               "1,Dee,Lee,a@x,1,addr,Town,NY,01234,1980-01-02,NA,100.50,None,2010-01-01,m,Retail,High,V,2024-01-01 10:00:00")
    target = os.path.join(root, "bronze_customers")
    batch = read_entity_files(spark, root, batch_id="b1")["bronze_customers"]
    with pytest.raises(DuplicateKeyError):
        append_checked(batch, target, "bronze_customers")
    assert not os.path.exists(target)
    n = append_checked(batch, target, "bronze_customers", mode="skip")
    assert n == 1 and n.rejects == {"date_of_birth: not date": 1, "missing key": 1, "repeated key": 1}
    stored = spark.read.parquet(rejects_path(target)).collect()
    assert len(stored) == 3 and all(r.batch_id == "b1" and r.source_file == "crm_customers.csv" for r in stored)
    again = append_checked(batch, target, "bronze_customers", mode="skip")
    assert again == 0 and again.rejects["stored key"] == 2


def test_only_a_missing_path_is_skipped(spark):
    root = tempfile.mkdtemp(prefix="tallyrisk-broken-")
    target = os.path.join(root, "bronze_accounts")
    os.makedirs(target)
    with open(os.path.join(target, "part-0.parquet"), "w") as fh:
        fh.write("no parquet")
    batch = spark.createDataFrame([(1,)], "account_id long").withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in RAW_SCHEMAS["bronze_accounts"].fields if f.name != "account_id"})
    with pytest.raises(Exception):
        append_checked(batch, target, "bronze_accounts")


def test_key_checked_append(spark, small_dir):
    target = os.path.join(tempfile.mkdtemp(prefix="tallyrisk-bronze-"), "bronze_accounts")
    batch = with_lineage(bronze_frames(spark, small_dir)["bronze_accounts"](), batch_id="b1",
                         source_file="erp_accounts.csv")
    n = batch.count()
    assert append_checked(batch, target, "bronze_accounts") == n
    with pytest.raises(DuplicateKeyError):
        append_checked(batch, target, "bronze_accounts", mode="fail")
    assert spark.read.parquet(target).count() == n
    assert append_checked(batch, target, "bronze_accounts", mode="skip") == 0
    extra = batch.withColumn("account_id", F.col("account_id") + 1_000_000)
    assert append_checked(batch.unionByName(extra), target, "bronze_accounts", mode="skip") == n
    assert spark.read.parquet(target).count() == 2 * n


def test_store_versions(spark):
    store = LayerStore(spark, tempfile.mkdtemp(prefix="tallyrisk-store-"), keep=2)
    df = spark.range(5).withColumnRenamed("id", "x")
    for version in ("v9", "v10"):
        assert store.publish("t", df, version)
    assert store.latest("t") == "v10"
    with pytest.raises(ValueError):
        store.publish("t", df.filter("x < 0"), "v10")      # published already: refused, not overwritten
    assert store.read("t").count() == 5
    assert store.publish("t", df.filter("x < 2"), "v11")
    assert store.read("t").count() == 2 and not os.path.exists(store.path("t", "v9"))
    assert os.path.exists(store.path("t", "v10"))


def test_partitioned_publish_writes_few_files(spark):
    store = LayerStore(spark, tempfile.mkdtemp(prefix="tallyrisk-store-"))
    df = spark.range(20_000).select("id", F.expr("date'2024-01-01' + cast(id % 30 as int)").alias("d")).repartition(16)
    store.publish("t", df, "v1", partition_by=["d"])
    files = sum(n.endswith(".parquet") for _, _, names in os.walk(store.path("t", "v1")) for n in names)
    assert 30 <= files <= 60 and store.read("t").count() == 20_000


def test_store_keeps_previous_version(spark):
    store = LayerStore(spark, tempfile.mkdtemp(prefix="tallyrisk-store-"))
    df = spark.range(5).withColumnRenamed("id", "x")
    assert store.publish("t", df, "0001")
    assert not store.publish("t", df.filter("x < 0"), "0002")   # empty: not published
    assert store.latest("t") == "0001" and store.read("t").count() == 5
    assert store.publish("t", df.filter("x < 2"), "0003")
    assert store.read("t").count() == 2


def test_skip_mode_drops_null_keys(spark, small_dir):
    target = os.path.join(tempfile.mkdtemp(prefix="tallyrisk-bronze-"), "bronze_accounts")
    batch = with_lineage(bronze_frames(spark, small_dir)["bronze_accounts"](), batch_id="b1",
                         source_file="erp_accounts.csv")
    nulls = batch.limit(3).withColumn("account_id", F.lit(None).cast("int"))
    with pytest.raises(DuplicateKeyError):
        append_checked(batch.unionByName(nulls), target, "bronze_accounts", mode="fail")
    assert append_checked(batch.unionByName(nulls), target, "bronze_accounts", mode="skip") == batch.count()
    assert spark.read.parquet(target).filter("account_id IS NULL").count() == 0


def test_unfinished_version_is_never_read(spark):
    """A version written without its completion marker (a job that died) is ignored."""
    root = tempfile.mkdtemp(prefix="tallyrisk-store-")
    store = LayerStore(spark, root)
    df = spark.range(4).withColumnRenamed("id", "x")
    assert store.publish("t", df, "20240101_000000_a")
    # a later version whose writer died before publishing: files but no marker
    df.filter("x < 1").write.parquet(store.path("t", "20240102_000000_b"))
    assert store.latest("t") == "20240101_000000_a" and store.read("t").count() == 4
