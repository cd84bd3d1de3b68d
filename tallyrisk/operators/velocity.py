"""Real definitions of the columns the source system only reserved.

Rolling counts and sums (E08-E13) over RANGE frames on the event time
(current row and its time peers included) are running sums along each key's
timeline: every row adds +value at its time, and an event -value just after its
frame ends.  A sliding frame would be re-aggregated whenever rows leave it
(quadratic in a dense stretch); a running sum is added up once.

:func:`running` puts rows and events of a key into one stream, hashed on (key,
bucket) and sorted by time, so one sort gives the running sums and the rows
together: no pairs of rows are built, and rows are joined with nothing.  Each
bucket's stream begins with an opening entry, the sum over the key's earlier
buckets.  The openings come from one aggregate by (key, bucket), combined
map-side, summed up over blocks of buckets and then inside the blocks.

The distinct-merchant count (E11) is one more measure: a merchant opens and
closes intervals.  First sightings (E14, E15) are marks that stand in the stream
just before their row.  Daily breakdowns (M-24) and repeat victims (E16) are
keyed aggregates.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrisk.operators.joins import join_dimension
from tallyrisk.operators.sequence import BLOCK, Cells, split_cells, with_cells

ONE_MICRO = "INTERVAL '0.000001' SECOND"
EPOCH = "1970-01-01 00:00:00"
WIDE = 1 << 64
# Entries of a stream; of one time and id a mark stands before its row.
OPENING, EVENT, MARK, ROW = 0, 1, 2, 3


def _hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def _cells_of(rows: DataFrame, key: str, ts: str, row_id: str, bucket_hours: int, rows_per_bucket: int | None) -> Cells:
    return split_cells(rows, key, ts, row_id, bucket_hours, rows_per_bucket) if rows_per_bucket else Cells(bucket_hours)


def _placed(t: DataFrame, key: str, ts: str, row_id: str) -> DataFrame:
    """``_who``: the key, or for rows without a key or time a number of their own; ``_placed`` tells them apart."""
    placed = F.col(key).isNotNull() & F.col(ts).isNotNull()
    alone = F.lit(-1) - F.pmod(F.xxhash64(row_id), F.lit(1 << 40))
    return t.withColumns({"_placed": placed, "_who": F.when(placed, F.col(key).cast("long")).otherwise(alone)})


def _bucketed(entries: DataFrame, cells: Cells) -> DataFrame:
    """``_bucket`` of entries (_who, _t, _id); events of a time whose rows are cut by their ids stand in a cell of their own."""
    out = with_cells(entries, "_who", "_t", "_id", cells)
    parts = F.col("_bucket")
    return out.withColumn("_bucket", F.struct(parts["_b"].alias("_b"), parts["_s"].alias("_s"),
                                              F.coalesce(parts["_i"], F.lit(-1).cast("long")).alias("_i")))


def _entries(t: DataFrame, ts: str, row_id: str, measures: dict[str, tuple[int, Column | None]], others: dict[str, str],
             payload: Column | None) -> DataFrame:
    """Rows and the ends of their frames: (_who, _t, _id, _kind, _row, a change of every measure).

    ``others``: measures that rows don't change, by their types.
    """
    one = F.lit(1).cast("long")
    value = {n: F.when(F.col("_placed"), F.coalesce(one if v is None else v, F.lit(0))).otherwise(F.lit(0)) for n, (_, v) in measures.items()}
    kind = {n: t.select(value[n].alias("x")).schema["x"].dataType for n in measures}
    none = [F.lit(0).cast(k).alias(n) for n, k in others.items()]
    id_type = t.schema[row_id].dataType
    shown = [] if payload is None else [payload.alias("_row")]
    # The key is part of the exploded entries: nothing is read past the generator.
    steps = [F.struct("_who", F.col(ts).alias("_t"), F.col(row_id).alias("_id"), F.lit(ROW).alias("_kind"), *shown,
                      *[value[n].cast(kind[n]).alias(n) for n in measures], *none)]
    for w in sorted({w for w, _ in measures.values()}):
        end = F.col(ts) + _hours(w) + F.expr(ONE_MICRO)
        hidden = [] if payload is None else [F.when(F.lit(False), payload).alias("_row")]
        steps.append(F.struct("_who", end.alias("_t"), F.lit(None).cast(id_type).alias("_id"), F.lit(EVENT).alias("_kind"), *hidden, *[
            (-value[n] if measures[n][0] == w else F.lit(0)).cast(kind[n]).alias(n) for n in measures], *none))
    several = F.when(F.col("_placed"), F.array(*steps)).otherwise(F.array(steps[0]))
    return t.select(F.explode(several).alias("e")).select("e.*")


def openings(sums: DataFrame, measures: list[str]) -> DataFrame:
    """The entry that a bucket's stream begins with, from the sums by (_who, _bucket).

    Sums over blocks of buckets first, then inside a block, so that a key's
    buckets are spread over tasks.  Cells of one instant (rows cut by their
    ids) open with the whole instant, as all its rows are peers.
    """
    at = F.col("_bucket")
    a = sums.withColumns({"_block": F.floor(at["_b"] / F.lit(BLOCK)), "_b": at["_b"], "_s": at["_s"]})
    blocks = a.groupBy("_who", "_block").agg(*[F.sum(m).alias(m) for m in measures])
    before = Window.partitionBy("_who").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("_who").alias("_w"), F.col("_block").alias("_wb"), *[F.sum(m).over(before).alias(f"_off_{m}") for m in measures])
    so_far = Window.partitionBy("_who", "_block").orderBy("_b", "_s").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    instant = Window.partitionBy("_who", "_block", "_b", "_s")
    a = a.select("_who", "_bucket", "_block", *[
        (F.sum(m).over(so_far) - F.when(at["_i"] == 0, F.sum(m).over(instant)).otherwise(F.lit(0))).alias(m) for m in measures])
    # A left join, as an inner one would put conditions into the sums' plan, whose exchanges are used again.
    a = a.join(blocks, (F.col("_who") == F.col("_w")) & (F.col("_block") == F.col("_wb")), "left")
    return a.select("_who", "_bucket", F.lit(OPENING).alias("_kind"), *[
        (F.col(m) + F.coalesce(F.col(f"_off_{m}"), F.lit(0))).alias(m) for m in measures])


def distinct_moves(placed: DataFrame, ts: str, value: str, width_hours: int, name: str) -> DataFrame:
    """(_who, _t, name): changes of the number of distinct non-NULL ``value`` in the frame.

    Rows of a (key, value) in one stretch as long as the frame are within the
    frame of one another, so only the first of a stretch can open an interval,
    and only the last can close one: by the neighbouring stretches.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(ts))
    stretch = F.floor(micros / F.lit(width_hours * 3_600_000_000)).alias("_stretch")
    s = placed.filter(F.col("_placed") & F.col(value).isNotNull()).groupBy("_who", value, stretch).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    along = Window.partitionBy("_who", value).orderBy("_stretch")
    s = s.select("_who", "_first", "_last", F.lag("_last").over(along).alias("_before"), F.lead("_first").over(along).alias("_next"))
    opens = F.coalesce(F.col("_first") > F.col("_before") + _hours(width_hours), F.lit(True))
    closes = F.coalesce(F.col("_next") > F.col("_last") + _hours(width_hours), F.lit(True))
    one = F.lit(1).cast("long")
    moves = F.array(F.when(opens, F.struct(F.col("_first").alias("_t"), one.alias(name))),
                    F.when(closes, F.struct((F.col("_last") + _hours(width_hours) + F.expr(ONE_MICRO)).alias("_t"), (-one).alias(name))))
    return s.select("_who", F.explode(F.filter(moves, lambda m: m.isNotNull())).alias("e")).select("_who", "e.*")


def first_marks(placed: DataFrame, ts: str, row_id: str, columns: list[str]) -> DataFrame:
    """(_who, _t, _id, _marks): the rows that are their key's first, by (ts, row_id), with their value of a column.

    NULL is a value; ``_marks`` is 2 ** n for the n-th column.  Time and id are
    compared as one number, which an aggregate keeps in place.
    """
    values = F.array(*[F.struct(F.lit(1 << n).alias("_marks"), F.col(c).cast("string").alias("_v")) for n, c in enumerate(columns)])
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(ts)).cast("decimal(19,0)")
    wide = F.lit(Decimal(WIDE)).cast("decimal(20,0)")
    # The id is moved into 0 .. 2 ** 64 - 1.
    at = (micros * wide + F.col(row_id).cast("decimal(20,0)") + F.lit(Decimal(WIDE // 2)).cast("decimal(20,0)")).cast("decimal(38,0)")
    first = (placed.filter("_placed").select("_who", at.alias("_at"), F.explode(values).alias("e"))
             .groupBy("_who", "e._marks", "e._v").agg(F.min("_at").alias("_at")))
    rest = F.pmod(F.col("_at"), wide)
    time = ((F.col("_at") - rest) / wide).cast("decimal(19,0)").cast("long")
    return first.select(
        "_who", F.timestamp_add("MICROSECOND", time, F.lit(EPOCH).cast("timestamp_ntz")).alias("_t"),
        (rest - F.lit(Decimal(WIDE // 2)).cast("decimal(20,0)")).cast("long").cast(placed.schema[row_id].dataType).alias("_id"), "_marks")


def running(t: DataFrame, key: str, ts: str, row_id: str, measures: dict[str, tuple[int, Column | None]],
            distinct: dict[str, tuple[int, str]] | None = None, firsts: dict[str, str] | None = None,
            bucket_hours: int = 24, rows_per_bucket: int | None = None, basics: DataFrame | None = None) -> DataFrame:
    """``t`` with RANGE-frame sums over [ts - width, ts] of the key (ties included), distinct counts and first sightings.

    ``measures``: name -> (width in hours, value Column, or None to count
    rows); ``distinct``: name -> (width, column); ``firsts``: flag -> column.
    Rows without a key or time have NULL sums and False flags.  The rows are
    shuffled once at full width.  ``basics``: the same rows before costly
    steps, for the passes that only read key, time, id and values.
    """
    distinct, firsts = distinct or {}, firsts or {}
    source = _placed(t if basics is None else basics, key, ts, row_id)
    placed = source.filter("_placed")
    cells = _cells_of(placed, key, ts, row_id, bucket_hours, rows_per_bucket)
    others = {n: "long" for n in distinct}
    names = [*measures, *others]
    id_type = t.schema[row_id].dataType
    rows = _entries(_placed(t, key, ts, row_id), ts, row_id, measures, others, F.struct(*t.columns))
    parts = {n: distinct_moves(source, ts, c, w, n) for n, (w, c) in distinct.items()}
    moves = None
    for n, m in parts.items():
        m = m.select("_who", "_t", F.lit(None).cast(id_type).alias("_id"), F.lit(EVENT).alias("_kind"), *[
            F.col(x) if x == n else F.lit(0).cast(rows.schema[x].dataType).alias(x) for x in names])
        moves = m if moves is None else moves.unionByName(m)
    bare = _entries(placed, ts, row_id, measures, others, None)
    entries = rows
    if moves is not None:
        bare, entries = bare.unionByName(moves), entries.unionByName(moves, allowMissingColumns=True)
    if firsts:
        marks = first_marks(source, ts, row_id, list(firsts.values())).withColumn("_kind", F.lit(MARK))
        entries = entries.unionByName(marks, allowMissingColumns=True)
    entries = _bucketed(entries, cells)
    if names:
        sums = _bucketed(bare, cells).groupBy("_who", "_bucket").agg(*[F.sum(n).alias(n) for n in names])
        # In the cells of one instant everything is in the opening.
        change = [F.when(F.col("_bucket._i") == 0, F.coalesce(n, F.lit(0))).otherwise(F.lit(0)) for n in names]
        entries = entries.withColumns(dict(zip(names, change, strict=True))).unionByName(openings(sums, names), allowMissingColumns=True)
    stream = entries.repartition(F.col("_who"), F.col("_bucket"))
    cell = Window.partitionBy("_who", "_bucket")
    if firsts:
        order = cell.orderBy(F.col("_t").asc_nulls_first(), F.col("_id").asc_nulls_first(), "_kind")
        # A row's marks, one a column at most, stand just before it; other entries have none.
        stream = stream.withColumn("_marks", F.coalesce(*[
            sum((F.lag("_marks", k + 1).over(order) for k in range(n)), F.lit(0)) for n in range(len(firsts), 0, -1)], F.lit(0)))
    peers = cell.orderBy(F.col("_t").asc_nulls_first()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    stream = stream.withColumns({n: F.sum(n).over(peers) for n in names}).filter(F.col("_kind") == ROW)
    known = F.col("_row")[key].isNotNull() & F.col("_row")[ts].isNotNull()
    return stream.select(
        "_row.*", *[F.when(known, F.col(n)).alias(n) for n in names],
        *[(known & (F.col("_marks").bitwiseAND(1 << i) != 0)).alias(n) for i, n in enumerate(firsts)])


def rolling(df: DataFrame, key: str, ts: str, row_id: str, measures: dict[str, tuple[int, Column | None]],
            bucket_hours: int = 24, rows_per_bucket: int | None = None) -> DataFrame:
    """``row_id`` and the measures (:func:`running`) of the rows that have a time."""
    rows = df.filter(F.col(ts).isNotNull())
    return running(rows, key, ts, row_id, measures, bucket_hours=bucket_hours, rows_per_bucket=rows_per_bucket).select(row_id, *measures)


def distinct_in_range(df: DataFrame, key: str, ts: str, value: str, row_id: str,
                      width_hours: int, bucket_hours: int = 24,
                      rows_per_bucket: int | None = None) -> DataFrame:
    """Per row with a time: number of distinct non-NULL ``value`` of its key over [ts - width, ts] (ties included)."""
    rows, name = df.filter(F.col(ts).isNotNull()), f"distinct_{value}"
    return running(rows, key, ts, row_id, {}, {name: (width_hours, value)}, bucket_hours=bucket_hours,
                   rows_per_bucket=rows_per_bucket).select(row_id, name)


def with_first_sightings(rows: DataFrame, key: str, ts: str, row_id: str, columns: dict[str, str],
                         bucket_hours: int = 24, rows_per_bucket: int | None = None) -> DataFrame:
    """Add flags (name -> column): the key's first row, by (ts, row_id), with this value of the column (NULL being one)."""
    return running(rows, key, ts, row_id, {}, firsts=columns, bucket_hours=bucket_hours, rows_per_bucket=rows_per_bucket)


VELOCITY_COLUMNS = ["transaction_count_1h", "transaction_count_24h", "transaction_amount_24h", "unique_merchants_24h",
                    "account_transaction_count_7d", "balance_change_24h", "is_new_device", "is_new_location"]


def with_velocity(t: DataFrame, rows_per_bucket: int | None = 2_000_000, bucket_hours: int = 24) -> DataFrame:
    """E08-E15 added to every row of silver_transactions (its other columns ride along).

    Rows without a customer, account or time have NULL in that key's sums and
    False in the sightings.  ``rows_per_bucket`` only splits the work.  Two
    full-width shuffles: the customers' stream and the accounts'.
    """
    ts, row, split = "transaction_timestamp", "transaction_id", {"bucket_hours": bucket_hours, "rows_per_bucket": rows_per_bucket}
    out = running(t, "customer_id", ts, row, {
        "transaction_count_1h": (1, None), "transaction_count_24h": (24, None), "transaction_amount_24h": (24, F.col("amount_abs"))},
        {"unique_merchants_24h": (24, "merchant_name_clean")},
        {"is_new_device": "device_id", "is_new_location": "merchant_location"}, **split)
    out = running(out, "account_id", ts, row, {
        "account_transaction_count_7d": (24 * 7, None), "balance_change_24h": (24, F.col("amount"))}, basics=t, **split)
    kinds = {c: "decimal(22,2)" if c in ("transaction_amount_24h", "balance_change_24h") else "bigint"
             for c in VELOCITY_COLUMNS[:6]}
    return out.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})


def velocity_features(t: DataFrame, rows_per_bucket: int | None = 2_000_000) -> DataFrame:
    """E08-E15 per transaction of silver_transactions."""
    base = t.select("transaction_id", "customer_id", "account_id", "transaction_timestamp", "amount",
                    "amount_abs", "merchant_name_clean", "device_id", "merchant_location")
    return with_velocity(base, rows_per_bucket).select("transaction_id", *VELOCITY_COLUMNS)


def merchant_category_risk(t: DataFrame) -> DataFrame:
    """M-23 (real): category fraud rate mapped to a score 1..9."""
    g = t.groupBy("merchant_category").agg(F.count(F.lit(1)).alias("txn_count"),
                                           F.count_if(F.col("is_fraud")).alias("fraud_count"))
    rate = F.col("fraud_count") / F.col("txn_count")
    return g.select("merchant_category", "txn_count", "fraud_count", rate.alias("fraud_rate"),
                    F.least(F.lit(9), F.lit(1) + F.floor(rate * 9)).cast("int").alias("merchant_risk_score"))


def satisfaction_average(interactions: DataFrame) -> DataFrame:
    """M-25 (real): mean satisfaction score per customer (NULL scores skipped)."""
    return interactions.groupBy("customer_id").agg(
        F.avg(F.col("satisfaction_score").cast("double")).cast("decimal(3,2)").alias("satisfaction_score_avg"))


def with_holidays(t: DataFrame, holidays: DataFrame) -> DataFrame:
    """T-14 (real): ``is_holiday``, whether the row's date is in the given calendar (joined on the date)."""
    days = holidays.select(F.col("holiday_date").cast("date").alias("_d")).distinct().withColumn("_h", F.lit(True))
    j = join_dimension(t.withColumn("_d", F.to_date("transaction_timestamp")), days, "_d")
    return j.withColumn("is_holiday", F.coalesce(F.col("_h"), F.lit(False))).drop("_h", "_d")


def holiday_flags(t: DataFrame, holidays: DataFrame) -> DataFrame:
    """T-14 (real) as (transaction_id, is_holiday)."""
    return with_holidays(t.select("transaction_id", "transaction_timestamp"), holidays).select("transaction_id", "is_holiday")


def daily_breakdowns(t: DataFrame) -> DataFrame:
    """M-24 and E16 (real): fraud counts by channel, category and hour per day,
    and customers defrauded that day who were already defrauded on an earlier day.

    One grouped pass serves the three breakdowns and the list of days, one the
    victims.  A list collected for a day has one entry a channel, hour or
    category, so its length depends on their number alone.
    """
    day = F.to_date("transaction_timestamp").alias("summary_date")
    keys = {"fraud_by_channel": "transaction_channel", "fraud_by_merchant_category": "merchant_category",
            "fraud_by_hour": "transaction_hour"}
    entries = F.array(*[F.struct(F.lit(n).alias("kind"), F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("k"))
                        for n, c in keys.items()])
    nothing = F.array(F.struct(F.lit("").alias("kind"), F.lit("").alias("k")))  # the day stays
    counts = (t.select(day, F.explode(F.when(F.col("is_fraud"), entries).otherwise(nothing)).alias("e"))
              .select("summary_date", "e.*").groupBy("summary_date", "kind", "k").agg(F.count(F.lit(1)).alias("n")))
    json = counts.groupBy("summary_date", "kind").agg(F.to_json(F.map_from_entries(F.array_sort(
        F.collect_list(F.struct("k", "n"))))).alias("json"))
    out = json.groupBy("summary_date").agg(*[
        F.coalesce(F.max(F.when(F.col("kind") == n, F.col("json"))), F.lit("{}")).alias(n) for n in keys])

    victim_days = t.filter(F.col("is_fraud") & F.col("customer_id").isNotNull()).select("customer_id", day).distinct()
    first = F.min("summary_date").over(Window.partitionBy("customer_id"))  # a row a day
    repeat = (victim_days.withColumn("_first", first).filter(F.col("summary_date") > F.col("_first"))
              .groupBy("summary_date").agg(F.count(F.lit(1)).alias("repeat_victims")))
    return out.join(repeat, "summary_date", "left").select(
        "summary_date", *keys, F.coalesce("repeat_victims", F.lit(0)).cast("bigint").alias("repeat_victims"))
