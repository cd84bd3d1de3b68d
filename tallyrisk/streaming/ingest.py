"""Landing folder -> bronze table, file by file, exactly once.

A stream of file names decides which files a micro-batch has; the checkpoint
keeps it.  Every micro-batch reads its files like the batch loader (large ones
in ranges) and appends them as the load ``<stream>@<epoch>``: a replayed epoch
finds its commit record and does nothing, one that died half-way is run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyrisk.schemas import PRIMARY_KEYS, RAW_SCHEMAS
from tallyrisk.sources.loads import Loads
from tallyrisk.sources.raw_files import RAW, REASONS, append_checked, load_time, scan_raw_csv, with_lineage

FILE_NAMES = "path string, modificationTime timestamp, length long, content binary"


def start_ingest(spark: SparkSession, landing_dir: str, table: str, target: str, checkpoint: str,
                 available_now: bool = False, max_files: int = 100, multi_line: bool = True,
                 index_every: int = 100) -> StreamingQuery:
    """Start streaming ``landing_dir`` (CSV files of one entity) into ``target``.

    ``checkpoint`` must be on shared storage.  ``available_now=True``
    processes what is there and stops (a scheduled incremental run).  Every
    micro-batch (at most ``max_files`` files) is a load with its own id and
    time; what it can't load goes to the target's rejects with its reason.
    After ``index_every`` loads the small loads are merged and the stored keys
    indexed (0: never).
    """
    schema = RAW_SCHEMAS[table]
    # Of the files only the names are read.
    found = (spark.readStream.format("binaryFile").schema(FILE_NAMES).option("maxFilesPerTrigger", max_files)
             .option("recursiveFileLookup", True).load(landing_dir).select("path"))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        load_id = f"{session.sparkContext.getLocalProperty('sql.streaming.queryId')}@{epoch_id}"
        loads = Loads(session, target)
        if loads.state().finished(load_id) is not None:
            return
        paths = [r["path"] for r in batch.collect()]  # at most max_files
        if paths:
            rows = with_lineage(scan_raw_csv(session, paths, schema, multi_line), load_time(), load_id).select(
                *schema.fieldNames(), "loaded_at", "source_file", "batch_id", REASONS, RAW)
            append_checked(rows, target, table, mode="skip", load_id=load_id)
        state = loads.state()
        if index_every and len(set(state.loads) - state.indexed()) >= index_every:
            loads.merge_small()
            loads.index(PRIMARY_KEYS[table], merge=len(state.levels) >= 8)

    writer = found.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def start_ingest_all(spark: SparkSession, landing_root: str, store_root: str, checkpoint_root: str,
                     available_now: bool = False) -> dict[str, StreamingQuery]:
    """One incremental load per entity: ``<landing_root>/<file stem>/`` -> bronze.

    Each entity has its own checkpoint under ``checkpoint_root`` (shared
    storage) and appends to ``<store_root>/<table>/current``, the path the
    layer runs read.
    """
    from tallyrisk.schemas import FILE_TO_TABLE

    queries = {}
    for file_name, table in FILE_TO_TABLE.items():
        stem = file_name.rsplit(".", 1)[0]
        queries[table] = start_ingest(
            spark, f"{landing_root.rstrip('/')}/{stem}", table, f"{store_root.rstrip('/')}/{table}/current",
            f"{checkpoint_root.rstrip('/')}/{table}", available_now=available_now)
    return queries
