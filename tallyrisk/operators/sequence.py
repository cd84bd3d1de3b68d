"""Per-customer sequence features that never put one customer in one task.

A plain ``Window.partitionBy(customer)`` sends all of a customer's rows to one
task; a customer holding a third of the data would then be one task.  Here
every row-level step is partitioned by (customer, bucket) instead, a bucket
being a stretch of the customer's (time, id) order, and what crosses buckets is
carried by a small summary:

* buckets are days (or ``bucket_hours``); a bucket that measures more than
  ``rows_per_bucket`` rows is cut into shorter stretches of time, these again
  where needed, and rows of one instant, or without a time, into ranges of the
  id (:func:`split_cells`), so a burst, a batch posting and an untimed load are
  all split, whatever else the customer's history holds;
* one aggregate over (customer, bucket, category), combined map-side, gives the
  whole-customer statistics (count, exact mean, sample std, first and last
  time), the last time before each bucket, and the bucket in which a category
  first appears for the customer, by windows over the summary;
* inside a bucket the previous time is a ``lag`` and the first row of a
  category a ``row_number``.

The fact rows are read twice (rows, summary), and once more, two columns wide,
when buckets are measured.  They are shuffled once at full width, on
(customer, bucket); joins and windows reuse that partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_TIME_BUCKET = 2 ** 62
#: Buckets (of the time alone) whose summaries are summed up together.
BLOCK = 32
#: A crowded stretch is cut into this many at a time.
FAN_OUT = 64
#: Lists of crowded stretches up to this length are broadcast; longer ones are joined by a shuffle.
BROADCAST_CELLS = 100_000


def time_bucket(ts: Column, bucket_hours: int) -> Column:
    """Monotone bucket number of a timestamp (width ``bucket_hours``).

    Rows without a time go to one bucket placed after all others, matching a
    nulls-last order of the events.
    """
    hours = F.timestamp_diff("HOUR", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.coalesce(F.floor(hours / F.lit(bucket_hours)), F.lit(NO_TIME_BUCKET))


@dataclass
class Cells:
    """Crowded stretches by level: ("time" or "id", width, rows of _key, _b, _s, _i, _low, _width)."""

    bucket_hours: int
    levels: list[tuple[str, int, DataFrame]] = field(default_factory=list)


def _offset(ts: Column, bucket_hours: int) -> Column:
    """Microseconds from the start of the time's bucket (0 without a time)."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.coalesce(F.pmod(micros, F.lit(bucket_hours * 3_600_000_000)), F.lit(0).cast("long"))


def _base(t: DataFrame, ts: str, bucket_hours: int) -> DataFrame:
    return t.withColumns({"_b": time_bucket(F.col(ts), bucket_hours), "_s": F.lit(0).cast("long"),
                          "_i": F.lit(0).cast("long")})


def _narrow(t: DataFrame, key: str, level: tuple[str, int, DataFrame], ts: str, row_id: str, bucket_hours: int) -> DataFrame:
    """One level down for the rows of the level's crowded stretches."""
    kind, width, crowded = level
    c = crowded.select(F.col("_key").alias("_ck"), F.col("_b").alias("_cb"), F.col("_s").alias("_cs"), F.col("_i").alias("_ci"),
                       F.col("_low").alias("_cl"), F.col("_width").alias("_cw"))
    inside = (F.col(key).eqNullSafe(F.col("_ck")) & (F.col("_b") == F.col("_cb")) & (F.col("_s") == F.col("_cs"))
              & (F.col("_i") == F.col("_ci")))
    hit = F.col("_cb").isNotNull()
    at = _offset(F.col(ts), bucket_hours) if kind == "time" else F.col(row_id).cast("long") - F.col("_cl")
    start = F.floor(at / F.col("_cw")).cast("long") * F.col("_cw")
    new = F.when(hit, start if kind == "time" else start + 1).otherwise(F.col("_s" if kind == "time" else "_i"))
    return t.join(c, inside, "left").withColumn("_s" if kind == "time" else "_i", new).drop(
        "_ck", "_cb", "_cs", "_ci", "_cl", "_cw")


def split_cells(t: DataFrame, key: str, ts: str, row_id: str, bucket_hours: int, rows_per_bucket: int) -> Cells:
    """Measure the buckets and find how the crowded ones are cut.

    Level by level: the stretches of a key with more than ``rows_per_bucket``
    rows (at most total rows / ``rows_per_bucket`` of them, whatever the data)
    are cut into FAN_OUT shorter ones, first by time, down to one microsecond,
    then by the integer ``row_id``, down to one id.  Ends when none is crowded.
    One counting pass over (key, time) where nothing is; a further one over the
    crowded stretches' rows for each level.
    """
    cells = Cells(bucket_hours)
    spark = t.sparkSession
    integral = isinstance(t.schema[row_id].dataType, T.IntegralType)
    rows = _base(t.select(key, ts, row_id), ts, bucket_hours)
    where = [key, "_b", "_s", "_i"]
    kind_of = t.schema[key].dataType.simpleString()
    schema = f"_key {kind_of}, _b long, _s long, _i long, _low long, _width long"
    width, kind = bucket_hours * 3_600_000_000, "time"
    ids = [F.min(F.col(row_id).cast("long")).alias("_lo"), F.max(F.col(row_id).cast("long")).alias("_hi")] if integral else []
    while True:
        counted = rows.groupBy(*where).agg(F.count(F.lit(1)).alias("_n"), *ids).filter(F.col("_n") > rows_per_bucket)
        crowded = counted.collect()
        if kind == "time" and crowded and (width == 1 or all(r["_b"] == NO_TIME_BUCKET for r in crowded)):
            kind, width = "id", None
        if not crowded or (kind == "id" and not integral):
            return cells
        found = []
        for r in crowded:
            if kind == "time":
                found.append((r[key], r["_b"], r["_s"], r["_i"], 0, max(1, width // FAN_OUT)))
            elif r["_hi"] is not None and r["_hi"] > r["_lo"]:
                found.append((r[key], r["_b"], r["_s"], r["_i"], r["_lo"], max(1, -(-(r["_hi"] - r["_lo"] + 1) // FAN_OUT))))
        if not found:
            return cells  # rows equal in time and id
        table = spark.createDataFrame(found, schema)
        if len(found) <= BROADCAST_CELLS:
            table = F.broadcast(table)
        cells.levels.append((kind, width or 0, table))
        if kind == "time":
            width = max(1, width // FAN_OUT)
        inside = table.select(*[F.col(c).alias(f"_in{n}") for n, c in enumerate(["_key", *where[1:]])])
        same = F.lit(True)
        for n, c in enumerate(where):
            same = same & F.col(c).eqNullSafe(F.col(f"_in{n}"))
        rows = _narrow(rows.join(inside, same, "left_semi"), key, cells.levels[-1], ts, row_id, bucket_hours)


def with_cells(t: DataFrame, key: str, ts: str, row_id: str, cells: Cells) -> DataFrame:
    """Add ``_bucket``: a struct that is monotone in (time, id) within a key."""
    out = _base(t, ts, cells.bucket_hours)
    for level in cells.levels:
        out = _narrow(out, key, level, ts, row_id, cells.bucket_hours)
    return out.withColumn("_bucket", F.struct("_b", "_s", "_i")).drop("_b", "_s", "_i")


def assign_buckets(t: DataFrame, key: str, ts: str, row_id: str, bucket_hours: int,
                   rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``_bucket``: days (``bucket_hours``), crowded ones cut by :func:`split_cells`.

    Every later step is right for any bucket that is monotone in (time, id)
    within a key, so this changes only how the work is split, never a result.
    """
    cells = split_cells(t, key, ts, row_id, bucket_hours, rows_per_bucket) if rows_per_bucket else Cells(bucket_hours)
    return with_cells(t, key, ts, row_id, cells)


def _merged(over, n: str, total: str, m2: str, mean) -> Column:
    """Sum of squared deviations from ``mean`` of parts (n, total, m2), by the parallel variance formula."""
    part = F.col(total).cast("double") / F.col(n)
    return F.sum(F.col(m2) + F.col(n) * F.pow(part - mean, 2)).over(over)


def group_summary(t: DataFrame, key: str, ts: str, value: str, group: str, blocks: bool = False) -> DataFrame:
    """One row per (key, bucket, group) carrying everything that crosses buckets.

    One aggregate, then windows over it.  Per key: the count, the exact mean,
    the sample standard deviation (parts merged with the parallel variance
    formula, and 0 where least and greatest value are the same) and the mean
    gap between events; per bucket: the last time before it; per row: whether
    the group appears in this bucket first (``_new_group``).

    ``blocks``: for keys with very many buckets.  The windows then run over
    blocks of BLOCK time buckets, and those over a whole key see a row a
    block, so a key's rows are spread over tasks.  Results are the same.
    """
    v = F.col(value)
    vd = v.cast("double")
    block = F.floor(F.col("_bucket")["_b"] / F.lit(BLOCK)) if blocks else F.lit(0).cast("long")
    g = t.groupBy(key, "_bucket", F.col(group).alias("_group")).agg(
        F.max(ts).alias("_last"), F.min(ts).alias("_first"),
        F.count(F.lit(1)).alias("_rows"), F.count_if(F.col(ts).isNull()).alias("_untimed"),
        F.count(v).alias("_n"), F.sum(v).alias("_sum"), F.min(v).alias("_least"), F.max(v).alias("_most"),
        (F.var_pop(vd) * F.count(v)).alias("_m2")).withColumn("_block", block)
    inside = Window.partitionBy(key, "_block")
    by_bucket = inside.orderBy("_bucket")
    n = F.sum("_n").over(inside)
    g = g.select("*", F.dense_rank().over(by_bucket).alias("_place"), n.alias("_n_value"), F.sum("_sum").over(inside).alias("_sum_value"),
                 F.sum("_rows").over(inside).alias("_n_rows"), F.sum("_untimed").over(inside).alias("_n_untimed"),
                 F.min("_first").over(inside).alias("_from"), F.max("_last").over(inside).alias("_to"),
                 F.min("_least").over(inside).alias("_low"), F.max("_most").over(inside).alias("_high"))
    g = g.withColumn("_mean_value", F.col("_sum_value").cast("double") / F.col("_n_value"))
    earlier = inside.orderBy("_place").rangeBetween(Window.unboundedPreceding, -1)
    of_group = F.min("_place").over(Window.partitionBy(key, "_block", "_group")) == F.col("_place")
    g = g.select("*", _merged(inside, "_n", "_sum", "_m2", F.col("_mean_value")).alias("_m2_value"),
                 F.max("_last").over(earlier).alias("_prev_bucket_last_ts"), of_group.alias("_new_group"))
    if blocks:
        g = _over_blocks(g, key)
    # Sum of gaps telescopes: 24 h for each row without a predecessor
    # (the first timed row and every untimed row) plus last - first.
    span_h = F.timestamp_diff("MICROSECOND", F.col("_from"), F.col("_to")) / F.lit(3.6e9)
    starts = F.col("_n_untimed") + F.when(F.col("_n_rows") > F.col("_n_untimed"), 1).otherwise(0)
    std = F.when(F.col("_low") == F.col("_high"), F.lit(0.0)).otherwise(
        F.sqrt(F.greatest(F.col("_m2_value"), F.lit(0.0)) / (F.col("_n_value") - 1)))
    return g.select(
        key, "_bucket", "_group", "_prev_bucket_last_ts", "_n_value", "_mean_value",
        F.when(F.col("_n_value") > 1, std).alias("_std_value"),
        ((F.lit(24.0) * starts + F.coalesce(span_h, F.lit(0.0))) / F.col("_n_rows")).alias("_mean_gap_hours"), "_new_group")


def _over_blocks(g: DataFrame, key: str) -> DataFrame:
    """The blocks' figures made those of the whole key: windows over one row a block, and a row a block and group."""
    facts = ["_n_value", "_sum_value", "_n_rows", "_n_untimed", "_from", "_to", "_low", "_high", "_m2_value"]
    one = g.groupBy(key, "_block").agg(*[F.any_value(c).alias(c) for c in facts])
    by_key = Window.partitionBy(key)
    before = by_key.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = {c: F.sum(c).over(by_key) for c in ("_n_value", "_sum_value", "_n_rows", "_n_untimed")}
    mean = sums["_sum_value"].cast("double") / sums["_n_value"]
    one = one.withColumn("_mean_value", mean)
    one = one.select(
        F.col(key).alias("_ok"), F.col("_block").alias("_ob"), "_mean_value", *[e.alias(c) for c, e in sums.items() if c != "_sum_value"],
        F.min("_from").over(by_key).alias("_from"), F.max("_to").over(by_key).alias("_to"),
        F.min("_low").over(by_key).alias("_low"), F.max("_high").over(by_key).alias("_high"),
        _merged(by_key, "_n_value", "_sum_value", "_m2_value", F.col("_mean_value")).alias("_m2_value"),
        F.max("_to").over(before).alias("_last_before"))
    groups = g.groupBy(key, "_block", "_group").agg(F.lit(True).alias("_here"))
    first = F.min("_block").over(Window.partitionBy(key, "_group")) == F.col("_block")
    groups = groups.select(F.col(key).alias("_gk"), F.col("_block").alias("_gb"), F.col("_group").alias("_gg"), first.alias("_first_block"))
    own = g.select(key, "_block", "_bucket", "_group", "_prev_bucket_last_ts", "_new_group")
    own = own.join(one, (F.col(key).eqNullSafe(F.col("_ok"))) & (F.col("_block") == F.col("_ob")))
    own = own.join(groups, F.col(key).eqNullSafe(F.col("_gk")) & (F.col("_block") == F.col("_gb")) & F.col("_group").eqNullSafe(F.col("_gg")))
    return own.withColumns({"_prev_bucket_last_ts": F.coalesce("_prev_bucket_last_ts", "_last_before"),
                            "_new_group": F.col("_new_group") & F.col("_first_block")})


def with_sequence_features(t: DataFrame, key: str = "customer_id", ts: str = "transaction_timestamp",
                           row_id: str = "transaction_id", value: str = "amount_abs",
                           group: str = "merchant_category",
                           bucket_hours: int = 24, rows_per_bucket: int | None = None,
                           bucket_col: str | None = None, prehashed: bool = False,
                           basics: DataFrame | None = None) -> DataFrame:
    """Add per-row sequence columns to ``t``.

    Adds ``_prev_ts`` (previous event time of the key, ties ordered by
    ``row_id``), ``_is_first_group`` (the key's first row with this ``group``)
    and the key statistics ``_n_value, _mean_value, _std_value,
    _mean_gap_hours`` where the mean gap treats a missing previous event as 24
    hours.  ``rows_per_bucket``: buckets with more rows are cut
    (:func:`split_cells`).  ``bucket_col`` uses a stored, non-NULL column that
    is monotone in (time, id) as the bucket instead; with ``prehashed`` the
    rows are taken as already hashed on (key, bucket_col), as in a table
    bucketed on those columns, and are not shuffled again.  ``basics``: the
    same rows before any enrichment, for the passes that only read key, time,
    value and group.
    """
    basics = t if basics is None else basics
    blocks = bool(bucket_col)  # buckets stored for a table of whatever size
    if bucket_col:
        t, basics = (d.withColumn("_bucket", F.col(bucket_col)) for d in (t, basics))
    else:
        cells = split_cells(basics, key, ts, row_id, bucket_hours, rows_per_bucket) if rows_per_bucket \
            else Cells(bucket_hours)
        t, basics = (with_cells(d, key, ts, row_id, cells) for d in (t, basics))
        blocks = bool(cells.levels)  # some key has crowded buckets
    aux = group_summary(basics, key, ts, value, group, blocks).withColumnsRenamed({key: "_k", "_bucket": "_kb"})

    # Hash rows on (key, bucket) explicitly: otherwise the window would reuse
    # an upstream partitioning on the key alone (e.g. from a dimension join)
    # and a hot key would again be a single task.  The join on (key, bucket,
    # group) keeps that partitioning (spark.sql.requireAllClusterKeysForCoPartition
    # is off, see tallyrisk.session).
    hashed = t if prehashed else t.repartition(F.col(key), F.col("_bucket"))
    rows = hashed.join(aux, (F.col(key) == F.col("_k")) & (F.col("_bucket") == F.col("_kb"))
                       & F.col(group).eqNullSafe(F.col("_group"))).drop("_k", "_kb", "_group")
    order = [F.col(ts).asc_nulls_last(), F.col(row_id)]
    w = Window.partitionBy(key, "_bucket").orderBy(*order)
    first = F.row_number().over(Window.partitionBy(key, "_bucket", group).orderBy(*order)) == 1
    return rows.withColumns({"_prev_ts": F.coalesce(F.lag(ts).over(w), F.col("_prev_bucket_last_ts")),
                             "_is_first_group": F.col("_new_group") & first})
