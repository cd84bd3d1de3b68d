"""Packing: token sequences of a fixed window by non-negative least squares.

Each document is tokenized once, ended by id 0 and cut into full windows and a
tail.  Tails are packed by the histogram of their lengths: all combinations of
up to three lengths that fill a window are enumerated, non-negative least
squares gives each one's repeat count, the counts are rounded within what the
histogram has, and what is left over is packed greedily (longest first, a
piece being cut only where nothing whole fits the gap).

Scale.  The driver sees the histogram alone: at most ``window`` - 1 counts.
Its answer is a table of runs ("tails of rank a to b of this length go to
sequences s, s + 1, ..., at this offset"); the number of runs depends on the
window, not on the data.  Ranks within a length come from blocks, so that a
length that a third of all documents share is no task of its own.  Full
windows are numbered by their place in the stored files and never shuffled.

Defined cases: a null text is packed as the empty text (only the id 0); equal
rows are packed each for itself; an empty table gives no pieces; other columns
are ignored.  Documents of any length are tokenized whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import gapless_rank, rows_at_once, ship_package, slices, stored

TOKENIZER = "byte_bpe_50k.json"
END = 0
#: Documents that a task holds at once: the largest part of an executor's memory here are texts on their way.
CUT_ROWS = 500
PIECES = "doc_id {id}, start long, length long, ids binary, doc_tokens long"


# --- tokens -----------------------------------------------------------------

@lru_cache(maxsize=2)
def _encoders(path: str):
    """(the tokenizer of the file, a faster encoder of the same vocabulary or None)."""
    import base64
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    ranks = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks):
        return slow, None
    import public_tokenizers
    import tiktoken
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return slow, tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                   special_tokens={})


@lru_cache(maxsize=1)
def _plain():
    """Texts in which both encoders agree on every character class: Latin letters, no odd white space."""
    import re
    return re.compile(r"[\t\n\r -~¡-¬®-ɏ]*")


def encode(text: str, path: str) -> np.ndarray:
    """Ids of a whole text as ``tokenizers`` gives them, and the end id."""
    slow, fast = _encoders(path)
    if fast is not None and _plain().fullmatch(text):
        ids = fast.encode_ordinary(text)
    else:
        ids = slow.encode(text, add_special_tokens=False).ids
    return np.array([*ids, END], dtype="<u4")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _cut(batches: Iterator[pa.RecordBatch], window: int, tokenizer: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    path = tokenizer_path(tokenizer)
    for batch in slices(batches, CUT_ROWS):
        which, starts, lengths, ids, totals = [], [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            tokens = encode(text or "", path)
            for start in range(0, len(tokens), window):
                piece = tokens[start:start + window]
                which.append(i)
                starts.append(start)
                lengths.append(len(piece))
                ids.append(piece.tobytes())
                totals.append(len(tokens))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(which, pa.int64())), pa.array(starts, pa.int64()),
             pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(totals, pa.int64())], schema=schema)


# --- the plan, from the histogram --------------------------------------------

def combinations(window: int) -> np.ndarray:
    """All a <= b <= c with a + b + c = window, 0 standing for no piece."""
    rows = []
    for a in range(window // 3 + 1):
        b = np.arange(a, (window - a) // 2 + 1)
        rows.append(np.stack([np.full(len(b), a), b, window - a - b], axis=1))
    return np.concatenate(rows)


def solve_nnls(combos: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 minimising the weighted |A x - histogram|, A's columns being the combinations.

    Accelerated projected gradient; A is applied through its three index
    columns.  Rows are weighted by 1 / sqrt(count + 1), so that rare lengths
    count as well.
    """
    size = len(histogram)
    weight = 1.0 / (histogram + 1.0)
    weight[0] = 0.0
    target = histogram.astype(float)
    scale = np.zeros(size)
    for j in range(3):
        scale += np.bincount(combos[:, j], minlength=size)
    # Diagonal majorizer: column step = 1 / sum over its rows of weight * row sum.
    row = np.zeros(size)
    for j in range(3):
        row += np.bincount(combos[:, j], minlength=size) * 3.0
    step = 1.0 / np.maximum((weight * row)[combos].max(axis=1), 1e-12)
    x = np.zeros(len(combos))
    y, t = x.copy(), 1.0
    for _ in range(steps):
        ax = np.zeros(size)
        for j in range(3):
            ax += np.bincount(combos[:, j], weights=y, minlength=size)
        g = weight * (ax - target)
        new = np.maximum(0.0, y - step * g[combos].sum(axis=1))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


class _Pool:
    """Tails still to be placed, by length: runs (class, first rank, last rank + 1, tokens cut off before)."""

    def __init__(self, histogram: np.ndarray):
        self.runs: dict[int, list[list[int]]] = {
            n: [[n, 0, int(c), 0]] for n, c in enumerate(histogram) if n and c}
        self.left = np.array(histogram, dtype=np.int64)
        self.left[0] = 0

    def take(self, length: int, count: int) -> list[tuple[int, int, int, int]]:
        out = []
        self.left[length] -= count
        runs = self.runs[length]
        while count:
            run = runs[-1]
            k = min(count, run[2] - run[1])
            out.append((run[0], run[1], run[1] + k, run[3]))
            run[1] += k
            count -= k
            if run[1] == run[2]:
                runs.pop()
        return out

    def give(self, length: int, runs: list[tuple[int, int, int, int]]) -> None:
        for run in runs:
            self.runs.setdefault(length, []).append(list(run))
            self.left[length] += run[2] - run[1]


def plan_tails(histogram: np.ndarray, window: int) -> tuple[pd.DataFrame, int]:
    """Runs (class, lo, hi, cut, length, sequence, offset) for all tails, and the number of sequences.

    The tail of rank r (lo <= r < hi) of the class puts its tokens
    [cut, cut + length) into sequence + (r - lo) at offset.
    """
    pool, rows, sequences = _Pool(histogram), [], 0

    def put(length: int, per_window: int, windows: int, offset: int, room: int) -> int:
        """``per_window`` pieces of ``length`` into each of the next windows; ``room`` < length cuts them."""
        for _ in range(per_window):
            first, rest = sequences, []
            for c, lo, hi, cut in pool.take(length, windows):
                rows.append((c, lo, hi, cut, min(length, room), first, offset))
                first += hi - lo
                rest.append((c, lo, hi, cut + room))
            if room < length:
                pool.give(length - room, rest)
            offset += min(length, room)
        return offset

    if pool.left.sum():
        combos = combinations(window - 0)
        combos = combos[(combos < window).all(axis=1)]
        x = solve_nnls(combos, pool.left)
        order = np.argsort(-x, kind="stable")
        order = order[x[order] > 1e-9]
        owed = 0.0
        for i in order:  # rounded so that the sums keep up with the sums of x
            owed += x[i]
            repeats = int(owed + 0.5)
            if not repeats:
                continue
            owed -= repeats
            parts, uses = np.unique(combos[i][combos[i] > 0], return_counts=True)
            repeats = min(repeats, int((pool.left[parts] // uses).min()))
            if repeats:
                offset = 0
                for part, k in zip(parts[::-1].tolist(), uses[::-1].tolist(), strict=True):
                    offset = put(part, k, repeats, offset, window)
                sequences += repeats
    while pool.left.any():
        gap, chosen, cutting = window, [], 0
        left = pool.left.copy()
        while gap and (fits := np.flatnonzero(left[1:gap + 1])).size:
            length = int(fits[-1]) + 1
            k = min(gap // length, int(left[length]))
            chosen.append((length, k))
            left[length] -= k
            gap -= k * length
        if gap and left.any():
            cutting = int(np.flatnonzero(left)[0])
            left[cutting] -= 1
        used = pool.left - left
        some = np.flatnonzero(used)
        repeats = int((pool.left[some] // used[some]).min())
        offset = 0
        for length, k in chosen:
            offset = put(length, k, repeats, offset, window)
        if cutting:
            put(cutting, 1, repeats, offset, gap)
        sequences += repeats
    columns = ["class", "lo", "hi", "cut", "length", "sequence", "offset"]
    plan = pd.DataFrame(rows, columns=columns, dtype="int64")
    return plan, sequences


# --- the operator -------------------------------------------------------------

def pack_documents(docs: DataFrame, window: int = 1024, tokenizer: str = TOKENIZER,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with their tokens: ``doc_id``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id``, ``offset``.

    Sequences are windows of ``window`` tokens; all but one of them are full.
    """
    spark = ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = PIECES.format(id=kind.simpleString())
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    with rows_at_once(spark, CUT_ROWS):
        pieces = stored(rows.mapInArrow(lambda it: _cut(it, window, tokenizer, arrow), schema), "pack-pieces")
    pieces = pieces.withColumns({"file": F.col("_metadata.file_name"), "row": F.col("_metadata.row_index")})

    tails = pieces.filter(F.col("length") < window)
    ranked = gapless_rank(stored(tails.select("file", "row", "length"), "pack-tails"),
                          ["length"], ["file", "row"], "rank")
    histogram = np.zeros(window, dtype=np.int64)
    for n, c in tails.groupBy("length").count().collect():  # window - 1 rows at most
        histogram[n] = c
    plan, sequences = plan_tails(histogram, window)

    # A rank's run by binary search; runs that take parts of one cut piece overlap and come as several rows.
    edges = pd.concat([plan[["class", "lo"]].rename(columns={"lo": "at"}),
                       plan[["class", "hi"]].rename(columns={"hi": "at"})])
    edges = edges.drop_duplicates().sort_values(["class", "at"], ignore_index=True)
    spots = (edges["class"].to_numpy() << 44) + edges["at"].to_numpy()  # ranks stay far below 2**44
    first = np.searchsorted(spots, (plan["class"].to_numpy() << 44) + plan["lo"].to_numpy())
    last = np.searchsorted(spots, (plan["class"].to_numpy() << 44) + plan["hi"].to_numpy())
    plan = plan.loc[np.repeat(plan.index, last - first)].assign(
        segment=np.concatenate([np.arange(a, b) for a, b in zip(first, last, strict=True)] or [np.empty(0, int)]))
    shared = spark.sparkContext.broadcast(spots)

    @F.pandas_udf("long")
    def segment(length: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, (length.to_numpy() << 44) + rank.to_numpy(), side="right") - 1)

    table = spark.createDataFrame(
        plan[["segment", "lo", "cut", "length", "sequence", "offset"]],
        "segment_r long, lo long, cut long, take long, sequence long, offset long")
    if len(plan) <= 500_000:  # a few thousand for a window of 1024; beyond, a shuffled join
        table = F.broadcast(table)
    ranked = ranked.withColumn("segment", segment("length", "rank"))
    placed = ranked.join(table, F.col("segment") == F.col("segment_r")).select(
        F.col("file").alias("file_r"), F.col("row").alias("row_r"), "cut", "take",
        (F.col("sequence") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset")
    packed = tails.join(placed, (F.col("file") == F.col("file_r")) & (F.col("row") == F.col("row_r"))).select(
        "doc_id", (F.col("start") + F.col("cut")).alias("start"), F.col("take").alias("length"),
        F.expr("substring(ids, cast(4 * cut + 1 as int), cast(4 * take as int))").alias("ids"),
        "doc_tokens", "sequence_id", "offset")

    # Full windows: numbered after the tails' sequences, by file and row.
    full = pieces.filter(F.col("length") == window)
    files = full.groupBy("file").agg((F.max("row") + 1).alias("rows")).orderBy("file").toPandas()  # one row a file
    files["base"] = files["rows"].cumsum() - files["rows"]
    bases = spark.createDataFrame(files[["file", "base"]], "file_r string, base long")
    files = F.broadcast(bases) if len(files) <= 200_000 else bases  # beyond, a shuffled join
    full = full.join(files, F.col("file") == F.col("file_r")).select(
        "doc_id", "start", "length", "ids", "doc_tokens",
        (F.lit(sequences) + F.col("base") + F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed)
