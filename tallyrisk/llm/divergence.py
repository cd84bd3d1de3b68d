"""Source divergence audit: term stripes folded inside the mappers.

A term is a maximal run of characters that are letters A to Z or lie beyond
ASCII, A to Z lower-cased.  Every language keeps the V terms that occur in at
least ``least_documents`` of its documents.  A group is a (language, source)
pair that occurs, or a whole language; it gives each kept term, found count
times in it, p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N being the sum of
its counts.  Two groups differ in a term by f = floor((p - q)^2 / (p + q)).

1. *Stripes.*  A task folds whole documents into a hash from (language, term)
   to a stripe: for each source the document frequency and the count.  A hash
   of more than ``SPILL`` cells is put out and begun anew.  The cells are
   exchanged once, by (language, term), and summed there, a cell at a time; a
   term of every document brings a few cells a task, not its documents.
2. *Sums.*  V, and N by group, from the merged stripes.
3. *Divergences.*  The merged stripes of a language come in slices of some
   ``SLICE`` counts, each with the N of the language's groups beside it.  A slice
   directly emits its share of f between every two sources (added up inside
   the mapper) and each source's ten strongest terms; Spark adds and ranks.

All numbers are whole; each f is below 2^31, and the sums fit a long up to 8 * 10^9 kept terms.

Defined results: null text, language and source count as empty texts; an empty
language or source is a group like any other; a group without terms gives
every kept term 2 / (N + 2 V) with N = 0; a language that keeps no term has
pairs of value 0; repeated rows and ids count each for itself; ties go by the
item's UTF-8 bytes; very long texts are read whole; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import flat_array, ship_package, slices, stored
from .linking import small

#: In UTF-8 the characters beyond ASCII are the bytes from 0x80 on.
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Cells of a task's hash before it is put out.
SPILL = 300_000
#: Counts (terms x sources) of a slice of merged stripes, its least number of terms, and counts of one step inside it.
SLICE, LEAST, STEP = 1 << 17, 1 << 11, 1 << 20
#: Sums between two sources that a task holds before it puts them out.
HELD = 1 << 22
SCALE = 1_000_000_000


def terms(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())  # of bytes: A to Z alone


def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to cells (lang, term, source, documents, count); a cell without term names a group."""
    stripes: dict[str, dict[bytes, dict[str, list[int]]]] = {}
    groups: set[tuple[str, str]] = set()
    cells = 0
    for b in slices(batches, 500):
        for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            groups.add((lang, source))
            mine = stripes.setdefault(lang, {})
            for term, n in Counter(terms(text)).items():
                stripe = mine.get(term)
                if stripe is None:
                    mine[term] = {source: [1, n]}
                    cells += 1
                elif (cell := stripe.get(source)) is None:
                    stripe[source] = [1, n]
                    cells += 1
                else:
                    cell[0] += 1
                    cell[1] += n
            if cells > SPILL or len(groups) > SPILL:
                yield from _cells(stripes, groups)
                stripes, groups, cells = {}, set(), 0
    yield from _cells(stripes, groups)


def _cells(stripes: dict, groups: set) -> Iterator[pa.RecordBatch]:
    rows = [(lang, term, source, cell[0], cell[1]) for lang, mine in stripes.items()
            for term, stripe in mine.items() for source, cell in stripe.items()]
    rows += [(lang, None, source, 0, 0) for lang, source in groups]
    for i in range(0, len(rows), 50_000):
        lang, term, source, documents, count = zip(*rows[i:i + 50_000], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(term, pa.binary()), pa.array(source, pa.string()),
             pa.array(documents, pa.int64()), pa.array(count, pa.int64())], ["lang", "term", "source", "documents", "count"])


CELLS = "lang string, term binary, source string, documents long, count long"


def merged_stripes(docs: DataFrame, least_documents: int) -> DataFrame:
    """Stored (lang, term, stripe of (source, count)): the terms kept, and a row without term for each group."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    texts = texts.withColumn("text", F.col("text").cast("binary"))
    cells = texts.mapInArrow(fold, CELLS).repartition("lang", "term")
    merged = cells.groupBy("lang", "term", "source").agg(F.sum("documents").alias("documents"), F.sum("count").alias("count"))
    # The exchange by (lang, term) serves both groupings; a stripe has a cell a source at most.
    stripes = merged.groupBy("lang", "term").agg(
        F.sum("documents").alias("documents"), F.collect_list(F.struct("source", "count")).alias("stripe"))
    kept = F.col("term").isNull() | (F.col("documents") >= least_documents)
    return stored(stripes.filter(kept).select("lang", "term", "stripe"), "stripes")


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 count / total) in longs, by long division in three digits of 1,000; count <= total."""
    out, rest = np.zeros(np.broadcast(count, total).shape, np.int64), count
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return out + 1


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def emit(batches: Iterator[pa.RecordBatch], best: int) -> Iterator[pa.RecordBatch]:
    """Slices (lang, kept, totals by source, terms) to (lang, source, other, term, value): sums and strongest terms."""
    sums: dict[str, np.ndarray] = {}
    for b in slices(batches, 1):
        lang, kept = b.column("lang")[0].as_py(), b.column("kept")[0].as_py()
        totals = flat_array(pa.chunked_array([b.column("totals").flatten()])).to_numpy() + 2 * kept
        names = flat_array(pa.chunked_array([b.column("terms").flatten()]))
        order = sorted(range(len(names)), key=lambda i, t=names.field("term").to_pylist(): t[i])
        names = names.take(pa.array(order))
        texts, cells = names.field("term"), names.field("cells")
        bounds = np.concatenate([[0], np.cumsum(cells.value_lengths().to_numpy())])
        flat = cells.flatten()
        place, count = flat.field("place").to_numpy(), flat.field("count").to_numpy()
        n, whole = len(totals), int((totals - 2 * kept).sum()) + 2 * kept
        if lang not in sums and n * n <= HELD:
            if sum(m.size for m in sums.values()) + n * n > HELD:
                yield from _sums(sums)
                sums = {}
            sums[lang] = np.zeros((n, n), np.int64)
        rows, step = max(1, HELD // n), max(1, STEP // n)
        strongest: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for first in range(0, n, rows):  # one block unless the sources are very many
            block = range(first, min(first + rows, n))
            shared = sums[lang] if lang in sums else np.zeros((len(block), n), np.int64)
            for low in range(0, len(texts), step):
                high = min(low + step, len(texts))
                at = slice(bounds[low], bounds[high])
                found = np.zeros((n, high - low), np.int64)
                found[place[at], np.repeat(np.arange(high - low), np.diff(bounds[low:high + 1]))] = count[at]
                p = shares(found + 2, totals[:, None])
                q = shares(found.sum(axis=0) + 2, np.int64(whole))
                for i in block:
                    shared[i - first] += differences(p[i], p).sum(axis=1)
                    more = np.flatnonzero((found[i] > 0) & (p[i] > q))
                    value = differences(p[i, more], q[more])
                    ahead = np.argsort(-value, kind="stable")[:best]  # equal values: the terms' order
                    strongest[i] = sorted(strongest[i] + [(-int(value[j]), low + int(more[j])) for j in ahead])[:best]
            if lang not in sums:
                yield from _sums({lang: shared}, first)
        top = [(i, at, -value) for i, s in enumerate(strongest) for value, at in s]
        if top:
            source, at, value = (np.array(x, np.int64) for x in zip(*top, strict=True))
            yield _rows(lang, source, None, texts.take(pa.array(at)), value)
    yield from _sums(sums)


def _sums(sums: dict[str, np.ndarray], first: int = 0) -> Iterator[pa.RecordBatch]:
    for lang, m in sums.items():
        source, other = np.divmod(np.arange(m.size), m.shape[1])
        for i in range(0, m.size, 100_000):
            yield _rows(lang, first + source[i:i + 100_000], other[i:i + 100_000], None, m.ravel()[i:i + 100_000])


def _rows(lang: str, source: np.ndarray, other: np.ndarray | None, term: pa.Array | None, value: np.ndarray) -> pa.RecordBatch:
    n = len(source)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), pa.array(source, pa.int64()),
         pa.nulls(n, pa.int64()) if other is None else pa.array(other, pa.int64()),
         pa.nulls(n, pa.binary()) if term is None else term, pa.array(value, pa.int64())],
        ["lang", "source", "other", "term", "value"])


def source_divergences(docs: DataFrame, least_documents: int = 10, best: int = 10) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of both parts, ``pair`` and ``term``."""
    ship_package(docs.sparkSession)
    stripes = merged_stripes(docs, least_documents)
    cells = stripes.select("lang", "term", F.explode("stripe").alias("cell")).select(
        "lang", "term", F.col("cell.source").alias("source"), F.col("cell.count").alias("count"))
    # One row a group, its place among the sources of its language beside it (as many rows as the result has groups).
    places = Window.partitionBy("lang").orderBy("source")
    groups = stored(cells.groupBy("lang", "source").agg(F.sum("count").alias("total")).withColumn(
        "place", F.row_number().over(places) - 1), "groups")
    kept = stripes.filter("term IS NOT NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = stored(groups.groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "total"))), lambda x: x["total"]).alias("totals")).join(
        kept, "lang"), "totals")
    # Slices: a share of the language's terms by hash, of about SLICE counts or LEAST terms.
    size = F.greatest(F.lit(LEAST), F.lit(SLICE) / F.size("totals"))
    lengths = totals.select("lang", F.ceil(F.col("kept") / size).alias("slices"))
    named = groups.select("lang", "source", "place")
    placed = cells.filter("term IS NOT NULL").join(small(named), ["lang", "source"]).groupBy("lang", "term").agg(
        F.collect_list(F.struct("place", "count")).alias("cells"))
    sliced = placed.join(small(lengths), "lang").groupBy(
        "lang", F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice")).agg(
        F.collect_list(F.struct("term", "cells")).alias("terms"))
    shown = sliced.join(small(totals), "lang").select("lang", "kept", "totals", "terms").mapInArrow(
        lambda batches: emit(batches, best), "lang string, source long, other long, term binary, value long")
    emitted = stored(shown, "divergences")
    one, two = (groups.select("lang", F.col("source").alias(f"{s}_name"), F.col("place").alias(s)) for s in ("source", "other"))
    sums = emitted.filter("other IS NOT NULL").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    pairs = one.join(two, "lang").filter("source <> other").join(sums, ["lang", "source", "other"], "left").select(
        "lang", F.col("source_name").alias("source"), F.lit("pair").alias("part"), F.col("other_name").alias("item"),
        F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    strong = emitted.filter("term IS NOT NULL").join(small(one), ["lang", "source"]).select(
        "lang", F.col("source_name").alias("source"), F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [d.withColumn("rank", F.row_number().over(by_value)) for d in (pairs, strong)]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= best))
