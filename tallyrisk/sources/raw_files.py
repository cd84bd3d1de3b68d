"""Raw entity files -> bronze: typed CSV scan, load lineage, rejects, key-checked append."""

from __future__ import annotations

import datetime as dt
import logging
import re
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrisk.functions.temporal import as_of_ts
from tallyrisk.schemas import FILE_TO_TABLE, PRIMARY_KEYS, RAW_SCHEMAS
from tallyrisk.sources import files
from tallyrisk.sources.loads import Loads, State, missing_path, rejects_path
from tallyrisk.sources.quoted_csv import csv_records

log = logging.getLogger(__name__)

# --- Fixed values: text read as missing by the source system's CSV reader ---
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# ---------------------------------------------------------------------------

REASONS = "_reject_reasons"
RAW = "_raw"
MALFORMED = "_malformed"
PLACE = "_place"


def new_load_id(at: dt.datetime | None = None) -> str:
    """yyyyMMdd_HHmmss_ + 8 hex characters, of this load alone."""
    at = at or dt.datetime.now(dt.timezone.utc)
    return at.strftime("%Y%m%d_%H%M%S_") + uuid.uuid4().hex[:8]


def load_time() -> str:
    """The wall clock (UTC) as text, taken once at the start of a load."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def csv_options(multi_line: bool = True) -> dict[str, object]:
    """The source's dialect: quotes doubled inside quotes, with or without line breaks in them."""
    return {"header": True, "mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": multi_line,
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "columnNameOfCorruptRecord": MALFORMED}


def text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*[T.StructField(f.name, T.StringType(), True) for f in schema.fields],
                         T.StructField(MALFORMED, T.StringType(), True)])


def _typed(text: Column, kind: T.DataType) -> Column:
    """The value, or NULL where the text is none of the kind.  Whole numbers may be written as floats (4.0)."""
    if isinstance(kind, T.IntegralType):
        number = F.trim(text).try_cast("decimal(38,6)")
        return F.coalesce(F.trim(text).try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))
    return text if isinstance(kind, T.StringType) else F.trim(text).try_cast(kind)


def parse(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns, the reasons to reject the row (empty: none) and, for those rows, its texts.

    Missing-value tokens are NULL.  A value that is none of its column's type
    rejects the row ("column: not a TYPE"), as does a row of the wrong shape.
    """
    texts = {f.name: F.when(F.col(f.name).isin(NULL_TOKENS), F.lit(None)).otherwise(F.col(f.name)) for f in schema.fields}
    typed = {f.name: _typed(texts[f.name], f.dataType) for f in schema.fields}
    checked = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    fails = {f.name: texts[f.name].isNotNull() & typed[f.name].isNull() for f in checked}
    wrong = [F.when(fails[f.name], F.lit(f"{f.name}: not {f.dataType.simpleString()}")) for f in checked]
    malformed = F.col(MALFORMED).isNotNull()
    # Arrays and maps are made for the rows to reject only: a filter over an array is interpreted, for every row.
    any_wrong = reduce(Column.__or__, fails.values(), F.lit(False))
    reasons = F.when(malformed, F.array(F.lit("malformed row"))).when(
        any_wrong, F.filter(F.array(*wrong), lambda r: r.isNotNull())).otherwise(F.array().cast("array<string>"))
    values = F.map_from_arrays(F.array(*[F.lit(f.name) for f in schema.fields], F.lit("line")),
                               F.array(*[F.col(f.name) for f in schema.fields], F.col(MALFORMED)))
    return raw.select(*[typed[f.name].alias(f.name) for f in schema.fields], reasons.alias(REASONS),
                      F.when(malformed | any_wrong, values).alias(RAW), "source_file")


def scan_raw_csv(spark: SparkSession, path, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Headered CSV read as text and parsed; nothing is inferred, nothing is lost (:func:`parse`).

    Files are read in ranges, by several tasks each, also where quoted values
    hold line breaks (:mod:`quoted_csv`).  Without ``multi_line`` a line is a
    record, and one with a line break in it is rejected as malformed.
    """
    texts, options = text_schema(schema), csv_options(multi_line)
    if not multi_line:
        return parse(spark.read.schema(texts).options(**options).csv(path).select(
            "*", F.col("_metadata.file_name").alias("source_file")), schema)
    fields = ", ".join(f"`{f.name}` string" for f in texts.fields)
    kept = {k: str(v) for k, v in options.items() if k != "header"}
    # By inline, a record is split once: filters on its columns would each hold the whole from_csv otherwise.
    return parse(csv_records(spark, path).select(F.inline(F.array(F.from_csv("record", fields, kept))), "source_file"), schema)


def read_raw_csv(spark: SparkSession, path, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """The rows that parse, typed."""
    return scan_raw_csv(spark, path, schema, multi_line).filter(F.size(REASONS) == 0).select(*schema.fieldNames())


def with_lineage(df: DataFrame, loaded_at: str | None = None, batch_id: str | None = None,
                 source_file: str | None = None) -> DataFrame:
    """loaded_at, source_file (file base name), batch_id, one value of each time and id a load."""
    src = F.lit(source_file) if source_file is not None else F.col("source_file")
    return df.withColumns({
        "loaded_at": as_of_ts(loaded_at or load_time()),
        "source_file": src,
        "batch_id": F.lit(batch_id or new_load_id()),
    })


def read_entity_files(spark: SparkSession, raw_dir: str, loaded_at: str | None = None,
                      batch_id: str | None = None, multi_line: bool = True) -> dict[str, DataFrame]:
    """Route each known file to its bronze table; a missing file is skipped, any other error is raised.

    The frames also carry the reasons and texts of rows to reject (:func:`append_checked` takes them out).
    """
    loaded_at, batch_id = loaded_at or load_time(), batch_id or new_load_id()
    out = {}
    for file_name, table in FILE_TO_TABLE.items():
        path = f"{raw_dir.rstrip('/')}/{file_name}"
        try:
            df = scan_raw_csv(spark, path, RAW_SCHEMAS[table], multi_line)
        except AnalysisException as e:
            if not missing_path(e):
                raise
            log.warning("file not found, skipped: %s", path)
            continue
        lineage = with_lineage(df, loaded_at, batch_id)
        names = [*RAW_SCHEMAS[table].fieldNames(), "loaded_at", "source_file", "batch_id"]
        out[table] = lineage.select(*names, REASONS, RAW)
    return out


class DuplicateKeyError(ValueError):
    pass


class Appended(int):
    """Rows appended; ``rejects`` has the rejected ones by reason."""

    rejects: dict[str, int]

    def __new__(cls, rows: int, rejects: dict[str, int]):
        out = super().__new__(cls, rows)
        out.rejects = rejects
        return out


def append_checked(batch: DataFrame, target: str, table: str, mode: str = "fail",
                   staging: str | None = None, load_id: str | None = None) -> Appended:
    """Append a bronze batch to the table stored at ``target``, once for each ``load_id``.

    Rows that did not parse go to ``<target>_rejects`` with their texts and
    reasons.  ``mode="fail"``: a key already stored, repeated inside the batch
    or missing rejects the whole batch (nothing is appended).  ``mode="skip"``:
    such rows go to the rejects too (of repeated rows one is appended), the
    others are appended.  Returns the number of rows appended, with the rejects
    counted by reason.

    Rows and rejects are published together by the load's commit record
    (:mod:`loads`).  A load that has one is not repeated: its counts are
    returned.  One that died before is run again from the start.  Where another
    load was committed in the meantime, the keys are checked again.

    The batch is written once to ``staging`` (default: next to the target on
    the same storage), so the raw files are parsed once.
    """
    spark = batch.sparkSession
    loads, load_id = Loads(spark, target), load_id or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9._@-]+", load_id):
        raise ValueError(f"no load id: {load_id!r}")
    own_staging = staging is None
    staging = staging or f"{target.rstrip('/')}_staging/{uuid.uuid4().hex}"
    staged = None
    try:
        while True:
            state = loads.begin()
            done = state.finished(load_id)
            if done is not None:
                return Appended(done["rows"], done["rejects"])
            if staged is None:
                staged = _stage(batch, staging)
            facts = _write_load(staged, staging, loads, state, load_id, PRIMARY_KEYS[table], mode, table)
            if loads.commit(state, {"load": load_id, "facts": facts, "adopted": state.adopted}):
                if facts["rejects"]:
                    log.warning("%s: rejected %s", table, facts["rejects"])
                return Appended(facts["rows"], facts["rejects"])
    finally:
        if own_staging:
            for part in ("", "_marks"):
                files.delete(spark, staging + part)


def _stage(batch: DataFrame, staging: str) -> DataFrame:
    """The parsed batch in files, each row with its place in them."""
    if REASONS not in batch.columns:
        batch = batch.withColumns({REASONS: F.array().cast("array<string>"),
                                   RAW: F.lit(None).cast("map<string,string>")})
    batch.write.mode("overwrite").parquet(staging)
    return batch.sparkSession.read.parquet(staging).select(
        "*", F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")).alias(PLACE))


def _write_load(staged: DataFrame, staging: str, loads: Loads, state: State, load_id: str, key: list[str],
                mode: str, table: str) -> dict:
    """Write the rows and the rejects of a load, and tell how many they are."""
    spark = staged.sparkSession
    names = [c for c in staged.columns if c not in (REASONS, RAW, PLACE)]
    unparsed = staged.filter(F.size(REASONS) > 0)
    parsed = staged.filter(F.size(REASONS) == 0)
    has_key = F.lit(True)
    for k in key:
        has_key = has_key & F.col(k).isNotNull()
    keyed, keyless = parsed.filter(has_key), parsed.filter(~has_key)
    stored = loads.stored_keys(keyed, key, state)
    # Of a repeated key the row with the least hash stays; a hot key is a row a task by the time it is shuffled.
    repeated = keyed.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(F.xxhash64(*names).alias("hash"), PLACE)).alias("_first")).filter("_n > 1")
    if mode == "fail":
        if not (keyless.isEmpty() and repeated.isEmpty() and (stored is None or stored.isEmpty())):
            raise DuplicateKeyError(f"{table}: batch repeats stored or in-batch keys, or misses one; nothing appended")
        fresh, rejected = parsed, [unparsed]
    else:
        known = (keyed.limit(0).select(*key) if stored is None else stored).distinct().withColumn("_known", F.lit(True))
        # One row a doubtful key, in files: the join below then splits a hot key.
        known.join(repeated, key, "full_outer").write.mode("overwrite").parquet(f"{staging}_marks")
        marked = keyed.join(spark.read.parquet(f"{staging}_marks"), key, "left")
        last = F.coalesce(F.col(f"_first.{PLACE}") != F.col(PLACE), F.lit(False))
        lost = F.col("_known").isNotNull() | last
        fresh = marked.filter(~lost)
        reason = F.when(F.col("_known").isNotNull(), F.lit("stored key")).otherwise(F.lit("repeated key"))
        rejected = [unparsed, marked.filter(lost).withColumn(REASONS, F.array(reason)),
                    keyless.withColumn(REASONS, F.array(F.lit("missing key")))]
    seen = Observation()
    text = [F.min(key[0]).cast("string").alias("low"), F.max(key[0]).cast("string").alias("high")]
    fresh.select(*names).observe(seen, F.count(F.lit(1)).alias("rows"), *text).write.mode("overwrite").parquet(loads.path(load_id))
    rejects = rejected[0].select(*names, REASONS, RAW)
    for r in rejected[1:]:
        rejects = rejects.unionByName(r.select(*names, REASONS, RAW))
    path = f"{rejects_path(loads.target)}/load={load_id}"
    rejects.write.mode("overwrite").parquet(path)
    reasons = {r[0]: r[1] for r in spark.read.parquet(path).select(
        F.explode(REASONS).alias("reason")).groupBy("reason").count().collect()}
    facts = {k: seen.get[k] for k in ("rows", "low", "high")} | {"rejects": reasons}
    if not facts["rows"]:
        files.delete(spark, loads.path(load_id))
    if not reasons:
        files.delete(spark, path)
    return facts
