"""Queries over files and tables that Spark first writes from the given tables.

Every call writes into a new folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.plans import reports, runs
from tallyrisk.schemas import BRONZE_TABLES, FILE_TO_TABLE, GOLD_TABLES, PRIMARY_KEYS, RAW_SCHEMAS, SILVER_TABLES
from tallyrisk.session import shared_dir
from tallyrisk.sources.loads import Loads
from tallyrisk.sources.raw_files import RAW, REASONS, append_checked, read_raw_csv, scan_raw_csv, with_lineage
from tallyrisk.sources.results import ResultCache
from tallyrisk.sources.store import LayerStore, write_csv

LOAD_TIMES = ("2024-02-01 08:00:00", "2024-02-02 09:30:00")
NOTES_SQL = """'said "' || outcome || '", left' || chr(10) || 'on the ' || channel"""


def folder(df: DataFrame, name: str) -> str:
    return f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


def two_loads(L) -> DataFrame:
    """Bronze transactions stored by two loads."""
    t = L["bronze_transactions"]
    path = folder(t, "bronze_transactions")
    for n, at in enumerate(LOAD_TIMES):
        part = t.filter(F.pmod("transaction_id", F.lit(2)) == n)
        append_checked(with_lineage(part, at, f"load_{n}", f"part{n}.csv"), path, "bronze_transactions")
    return t.sparkSession.read.parquet(path)


def _dialect(df: DataFrame, path: str) -> None:
    """CSV as the source writes it: whole numbers of columns with gaps as floats, quotes doubled, line breaks kept."""
    df.write.option("header", True).option("escape", '"').option("quoteAll", False).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


def _interactions(L) -> tuple[DataFrame, str]:
    """The interactions as a file; one score in 17 is no number."""
    t = L["bronze_interactions"]
    score = F.when(F.col("interaction_id") % 17 == 0, F.lit("five")).otherwise(
        F.concat(F.col("satisfaction_score").cast("string"), F.lit(".0")))
    path = folder(t, "interactions_csv")
    _dialect(t.withColumns({"notes": F.expr(NOTES_SQL), "satisfaction_score": score}), path)
    return t, path


def csv_round_trip(L) -> DataFrame:
    t, path = _interactions(L)
    return read_raw_csv(t.sparkSession, path, RAW_SCHEMAS["bronze_interactions"])


def csv_rejects(L) -> DataFrame:
    t, path = _interactions(L)
    bad = scan_raw_csv(t.sparkSession, path, RAW_SCHEMAS["bronze_interactions"]).filter(F.size(REASONS) > 0)
    return bad.select(F.col(RAW)["interaction_id"].alias("interaction_id"), F.explode(REASONS).alias("reason"))


def append_skip(L) -> DataFrame:
    """A first load of a third, then all rows again, a third of them twice and a third once more without a key."""
    t = L["bronze_transactions"]
    spark, path, third = t.sparkSession, folder(t, "bronze_transactions"), F.pmod("transaction_id", F.lit(3))
    append_checked(with_lineage(t.filter(third == 0), LOAD_TIMES[0], "a", "a.csv"), path, "bronze_transactions")
    again = t.unionByName(t.filter(third == 1)).unionByName(
        t.filter(third == 2).withColumn("transaction_id", F.lit(None).cast("bigint")))
    n = append_checked(with_lineage(again, LOAD_TIMES[1], "b", "b.csv"), path, "bronze_transactions", mode="skip")
    stored = spark.read.parquet(path).agg(F.lit("stored").alias("outcome"), F.count(F.lit(1)).alias("row_count"))
    return stored.unionByName(spark.createDataFrame(list(n.rejects.items()), "outcome string, row_count long"))


def append_replay(L) -> DataFrame:
    """The loads of :func:`append_skip`, each run twice under its id, the stored keys indexed in between."""
    t = L["bronze_transactions"]
    spark, path, third = t.sparkSession, folder(t, "bronze_transactions"), F.pmod("transaction_id", F.lit(3))
    again = t.unionByName(t.filter(third == 1)).unionByName(
        t.filter(third == 2).withColumn("transaction_id", F.lit(None).cast("bigint")))
    for n, batch in enumerate((t.filter(third == 0), again)):
        for _ in range(2):
            append_checked(with_lineage(batch, LOAD_TIMES[n], f"s_{n}", "s.csv"), path, "bronze_transactions", "skip",
                           load_id=f"s@{n}")
        Loads(spark, path).index(PRIMARY_KEYS["bronze_transactions"])
    kept, lost = Loads(spark, path).read(), Loads(spark, path).rejects()
    return kept.groupBy(F.lit("stored").alias("outcome"), "transaction_id").agg(F.count(F.lit(1)).alias("row_count")).unionByName(
        lost.select(F.explode(REASONS).alias("outcome"), "transaction_id").groupBy("outcome", "transaction_id").agg(F.count(F.lit(1)).alias("row_count")))


def _stored_bronze(L) -> LayerStore:
    """The raw files written and loaded."""
    t = L["bronze_transactions"]
    raw = folder(t, "raw")
    for file_name, table in FILE_TO_TABLE.items():
        write_csv(L[table], f"{raw}/{file_name}")
    store = LayerStore(t.sparkSession, folder(t, "store"))
    runs.run_bronze(t.sparkSession, raw, store)
    return store


def stored_run(L, as_of: str) -> LayerStore:
    """A whole run: raw files, bronze, silver and gold, stored once for the queries over one set of layers."""
    store = getattr(L, "_stored_run", None)
    if store is None:
        store = _stored_bronze(L)
        with store.run("v1") as run:
            runs.run_silver(store.spark, store, as_of, run=run)
            runs.run_gold(store.spark, store, as_of, run=run)
        L._stored_run = store
    return store


def stored_bronze(L, as_of: str, table: str) -> DataFrame:
    store = stored_run(L, as_of)
    return Loads(store.spark, runs.bronze_path(store, table)).read()


def stored_table(L, as_of: str, table: str) -> DataFrame:
    return stored_run(L, as_of).read(table)


def _counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n, df in tables.items()])


def bronze_counts(L) -> DataFrame:
    store = _stored_bronze(L)
    return _counts({t: store.spark.read.parquet(runs.bronze_path(store, t)) for t in BRONZE_TABLES})


def silver_counts(L, as_of: str) -> DataFrame:
    store = _stored_bronze(L)
    runs.run_silver(store.spark, store, as_of, version="v1")
    return _counts({t: store.read(t) for t in SILVER_TABLES})


def gold_rejects(L, as_of: str) -> DataFrame:
    return stored_table(L, as_of, runs.REJECTED)


def observed_counts(L, as_of: str) -> DataFrame:
    """What the writing tasks counted: rows of every table, and the customers that met account totals."""
    store = stored_run(L, as_of)
    rows = [(t, k, v) for t in [*SILVER_TABLES, *GOLD_TABLES] for k, v in store.facts(t).items()]
    return store.spark.createDataFrame(rows, "table_name string, fact string, value long")


def dashboard_counts(L, as_of: str) -> DataFrame:
    """Rows of the five dashboard reports."""
    pack = reports.dashboard_pack(L["gold_fraud_features"], L["gold_daily_fraud_summary"], as_of)
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(n).alias("report"), F.count(F.lit(1)).alias("row_count")) for n, df in pack.items()])


#: The item that a row of a report is about, and its measures.
REPORT_COLUMNS = {
    "kpi_cards": (None, ["total_txns", "fraud_txns", "fraud_rate", "unique_customers"]),
    "fraud_by_hour": ("transaction_hour", ["total", "fraud", "fraud_rate"]),
    "risky_merchant_categories": ("merchant_category", ["total", "fraud", "fraud_rate"]),
    "daily_trend": ("summary_date", ["total_transactions", "fraudulent_transactions", "fraud_rate"]),
    "recent_fraud_alerts": ("transaction_id", ["customer_id", "amount", "amount_z_score"]),
}


def dashboard_contents(L, as_of: str) -> DataFrame:
    """The five reports over the stored tables, a row a report, item and measure."""
    tables = stored_run(L, as_of).snapshot(["gold_fraud_features", "gold_daily_fraud_summary"])
    pack = reports.dashboard_pack(*tables.values(), as_of)
    out = []
    for name, df in pack.items():
        item, measures = REPORT_COLUMNS[name]
        pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
        item = F.lit("") if item is None else F.col(item).cast("string")
        out.append(df.select(F.lit(name).alias("report"), item.alias("item"), F.explode(pairs).alias("p")).select(
            "report", "item", "p.measure", "p.value"))
    return reduce(DataFrame.unionByName, out)


def kept_result(L, as_of: str) -> DataFrame:
    """Fraud by merchant category as SQL, from the result that the first of two equal calls kept."""
    cache = ResultCache(stored_run(L, as_of), max_age=3600)
    sql = """SELECT merchant_category, count(*) AS total, count_if(is_fraud) AS fraud
             FROM {gold_fraud_features} WHERE transaction_timestamp >= :start GROUP BY ALL"""
    start = {"start": dt.datetime(2023, 7, 1)}
    cache.query(sql, ["gold_fraud_features"], start)
    return cache.query(sql, ["gold_fraud_features"], start)
