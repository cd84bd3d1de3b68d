"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrisk.session import shared_dir

#: Rows of one rank block; a block is the most that one task has to sort at once.
RANK_BLOCK_ROWS = 10_000


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python workers, once a context."""
    sc = spark.sparkContext
    if not getattr(sc, "_tallyrisk_shipped", False):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="tallyrisk-code-"), "tallyrisk_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        sc.addPyFile(path)
        sc._tallyrisk_shipped = True
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation,
    and values that later steps agree on (ranks, groups) can't change.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_bucket(column: str, modulus: int) -> Column:
    """crc32 of the column's text, modulo ``modulus`` (null column: of the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def gapless_rank(df: DataFrame, keys: list[str], order: list[str], name: str,
                 rows_per_block: int = RANK_BLOCK_ROWS) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within ``keys``, without a key's rows ever meeting in one task.

    Rows are dealt into hashed blocks of about ``rows_per_block``; block counts
    (combined map-side) give each block its first rank, and only the rows of
    one block are sorted together.  ``df`` should be a stored table.  Rows
    equal in ``order`` get different ranks in any order.  Null keys count as
    one key.
    """
    blocks = max(1, -(-df.count() // rows_per_block))
    own = [f"__k{i}" for i in range(len(keys))]
    d = df.withColumns({k: F.col(c) for k, c in zip(own, keys, strict=True)}
                       | {"__block": F.pmod(F.xxhash64(*order), F.lit(blocks))})
    counts = d.groupBy(*own, "__block").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*own).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*own, "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    first = first.select(*[F.col(c).alias(f"{c}r") for c in [*own, "__block"]], "__first")
    cond = F.col("__block") == F.col("__blockr")
    for c in own:
        cond = cond & F.col(c).eqNullSafe(F.col(f"{c}r"))
    inside = Window.partitionBy(*own, "__block").orderBy(*order)
    return (d.join(first, cond)
            .withColumn(name, F.col("__first") + F.row_number().over(inside) - 1)
            .select(*df.columns, name))


# --- words as integer codes -------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_strings(values: pa.Array, seed: int = 0) -> np.ndarray:
    """Stable 64-bit hash of each string: a polynomial over its UTF-8 bytes, finalized.

    Computed for all strings at once: byte i of every string is folded in turn,
    strings sorted by length so that the active ones are always a suffix.
    """
    values = values.cast(pa.large_binary())
    buffers = values.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[values.offset:values.offset + len(values) + 1]
    n = len(values)
    if not n:
        return np.empty(0, np.uint64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    lengths = np.diff(offsets)
    order = np.argsort(lengths, kind="stable")
    starts, sizes = offsets[:-1][order], lengths[order]
    h = np.full(n, np.uint64(0x9E3779B97F4A7C15 + seed), np.uint64)
    long = np.searchsorted(sizes, 64, side="right")  # the few long ones go one by one
    for i in range(int(sizes[long - 1]) if long else 0):
        a = np.searchsorted(sizes, i, side="right")
        h[a:long] = (h[a:long] ^ data[starts[a:long] + i]) * np.uint64(0x100000001B3)
        h[a:long] ^= h[a:long] >> np.uint64(29)
    if long < n:
        import xxhash
        for j in range(long, n):
            h[j] = xxhash.xxh64_intdigest(data[starts[j]:starts[j] + sizes[j]].tobytes(), seed=seed)
    out = np.empty(n, np.uint64)
    out[order] = mix64(h + sizes.astype(np.uint64))
    return out


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a batch of texts.

    ``codes[bounds[i]:bounds[i + 1]]`` are text i's words as indexes into
    ``vocabulary`` (distinct words of the batch).  Null texts have no words.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = pc.fill_null(unsliced(texts).cast(pa.large_string()), "")
        if lower:
            texts = pc.ascii_lower(texts)
        parts = pc.ascii_split_whitespace(texts)
        flat = parts.flatten()
        offsets = parts.offsets.to_numpy() - (parts.offsets[0].as_py() if len(parts) else 0)
        full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
        kept = np.concatenate([[0], np.cumsum(full)])
        self.bounds = kept[offsets].astype(np.int64) if len(offsets) else np.zeros(1, np.int64)
        encoded = flat.filter(pa.array(full)).dictionary_encode()
        self.codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocabulary = encoded.dictionary

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def owner(self) -> np.ndarray:
        """The text's index of every word."""
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of every vocabulary word."""
        return hash_strings(self.vocabulary, seed)


def window_hashes(word_hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows and the text of each, windows never crossing texts."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i:i + n])
    lengths = np.diff(bounds)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inside = owner[:n] == owner[size - 1:]
    return h[inside], owner[:n][inside]


def ngram_hashes(values: pa.Array, low: int, high: int, buckets: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams (``low`` to ``high``) of each string within <...>, and each one's string."""
    left, right, nothing = (pa.scalar(x, pa.large_string()) for x in ("<", ">", ""))
    marked = pc.binary_join_element_wise(left, values.cast(pa.large_string()), right, nothing).cast(pa.large_binary())
    buffers = marked.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[marked.offset:marked.offset + len(marked) + 1]
    if not len(marked):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), np.diff(offsets))
    grams, owners = [], []
    for n in range(low, high + 1):
        m = len(data) - n + 1
        if m <= 0:
            break
        h = np.full(m, np.uint64(n + 31 * seed), np.uint64)
        for i in range(n):
            h = (h ^ data[i:i + m]) * np.uint64(0x100000001B3)
        inside = owner[:m] == owner[n - 1:]
        grams.append((mix64(h[inside]) % np.uint64(buckets)).astype(np.int64))
        owners.append(owner[:m][inside])
    return np.concatenate(grams), np.concatenate(owners)


def unsliced(texts: pa.Array) -> pa.Array:
    """The same values from offset 0 (some string kernels misread arrays that begin within their buffers)."""
    return texts if texts.offset == 0 else texts.take(pa.array(np.arange(len(texts))))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, each from offset 0; empty batches are left out."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            part = b.slice(i, rows)
            yield b if part.num_rows == b.num_rows else part.take(pa.array(np.arange(part.num_rows)))
    give_back()


def give_back() -> None:
    """Return what this worker has freed to the system: workers stay for later stages, and others need the room."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not with every C library
        pass


@contextmanager
def rows_at_once(spark: SparkSession, rows: int):
    """At most so many rows a batch go to Python from the jobs inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 4000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of batches sorted by ``key``: (table, group bounds), at least ``rows`` at a time.

    A group that goes on in the next batch is held back until it is complete.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cuts = _cuts(table[key])
        if len(cuts) > 2:
            yield table.slice(0, cuts[-2]), cuts[:-1]
            rest = table.slice(cuts[-2])
            held, size = rest.take(pa.array(np.arange(rest.num_rows))).to_batches(), rest.num_rows
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _cuts(table[key])
        held = table = None
    give_back()


def _cuts(key: pa.ChunkedArray) -> np.ndarray:
    codes = key.combine_chunks().dictionary_encode()
    codes = (codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1, [len(codes)]])


def flat_array(column: pa.ChunkedArray) -> pa.Array:
    """One contiguous array from offset 0."""
    array = column.combine_chunks()
    if isinstance(array, pa.ChunkedArray):
        array = array.chunk(0) if array.num_chunks else pa.array([], array.type)
    return unsliced(array)
