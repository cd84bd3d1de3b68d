"""Benchmark decontamination: greedy string tiling of test items against documents.

Words are compared lower-cased and without the ASCII punctuation around them;
words of punctuation alone are left out.  Karp-Rabin hashes of all
``min_match``-word windows of the documents are joined with those of the test
items (the shared seeds).  For each document and item that share one,
consecutive seeds on a diagonal are joined to maximal matches; the longest is
marked first, a match that meets marked words is cut to its unmarked parts and
waits again, until none of ``min_match`` words is left.  The marked share of
the item's words is its coverage; tiles may stand in any order, so reordered
passages are found.

Scale.  The test items are the stated query set: they are taken in blocks of a
bounded number of seeds, each block is broadcast, and a document passes the
blocks one after the other inside one scan.  There is no shuffle and no
grouping, so a passage that a third of all documents share costs each
document its own work only.

Defined cases: null and empty texts match nothing; items of fewer words than
``min_match`` have no seed and match nothing; null item texts likewise; equal
items and equal documents are treated each for itself; an empty benchmark
leaves all documents clean; a text of any length is searched whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import Words, hash_strings, ship_package, slices, window_hashes

MIN_MATCH = 5
COVERAGE = 0.5
#: Words of test items in one broadcast block.
BLOCK_WORDS = 2_000_000
FILTER_BITS = 22
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MATCH = "struct<item_id:{item},coverage:double,tiles:array<struct<doc_word:int,item_word:int,words:int>>>"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the normalised words of all texts, and the texts' bounds."""
    words = Words(texts)
    vocabulary = pc.ascii_trim(words.vocabulary, characters=PUNCTUATION)
    full = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False) > 0
    kept = full[words.codes] if len(words.codes) else np.empty(0, bool)
    before = np.concatenate([[0], np.cumsum(kept)])
    return hash_strings(vocabulary, 3)[words.codes[kept]], before[words.bounds]


class Seeds:
    """The windows of a block of items, by hash."""

    def __init__(self, texts: pa.Array, min_match: int):
        self.min_match = min_match
        self.hashes, self.bounds = tokens(texts)
        seeds, item = window_hashes(self.hashes, self.bounds, min_match)
        lengths = np.maximum(np.diff(self.bounds) - min_match + 1, 0)
        place = np.arange(len(seeds)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item, self.place = seeds[order], item[order], place[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.seeds >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, its word, item, the item's word) of every shared window."""
        windows, doc = window_hashes(hashes, bounds, self.min_match)
        lengths = np.maximum(np.diff(bounds) - self.min_match + 1, 0)
        place = np.arange(len(windows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        maybe = np.flatnonzero(self.filter[(windows >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        low = np.searchsorted(self.seeds, windows[maybe], side="left")
        high = np.searchsorted(self.seeds, windows[maybe], side="right")
        number = high - low
        which = np.repeat(maybe, number)
        at = np.repeat(low - (np.cumsum(number) - number), number) + np.arange(number.sum())
        return doc[which], place[which], self.item[at], self.place[at]


def tile(doc_words: np.ndarray, item_words: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from the seeds' positions: (document word, item word, length), longest first."""
    diagonal = doc_words - item_words
    order = np.lexsort((doc_words, diagonal))
    diagonal, starts, places = diagonal[order], doc_words[order], item_words[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(diagonal) != 0) | (np.diff(starts) != 1)]))
    runs = np.diff(np.concatenate([new, [len(starts)]])) + min_match - 1
    heap = [(-int(n), int(d), int(i)) for n, d, i in zip(runs, starts[new], places[new], strict=True)]
    heapq.heapify(heap)
    in_doc: set[int] = set()
    in_item: set[int] = set()
    tiles = []
    while heap:
        n, d, i = heapq.heappop(heap)
        n = -n
        if not in_item and not in_doc:
            free = [True] * n
        else:
            free = [d + k not in in_doc and i + k not in in_item for k in range(n)]
        if all(free):
            tiles.append((d, i, n))
            in_doc.update(range(d, d + n))
            in_item.update(range(i, i + n))
            continue
        start = None
        for k in range(n + 1):
            if k < n and free[k]:
                start = k if start is None else start
            elif start is not None:
                if k - start >= min_match:
                    heapq.heappush(heap, (start - k, d + start, i + start))
                start = None
    return tiles


def matches(texts: pa.Array, seeds: Seeds, coverage: float) -> dict[int, list[tuple[int, float, list]]]:
    """For each text with a covered item: (item, coverage, tiles)."""
    doc, word, item, place = seeds.hits(*tokens(texts))
    sizes = np.diff(seeds.bounds)
    found: dict[int, list[tuple[int, float, list]]] = {}
    if not len(doc):
        return found
    order = np.lexsort((item, doc))
    doc, word, item, place = doc[order], word[order], item[order], place[order]
    cuts = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0)]))
    for a, b in zip(cuts, [*cuts[1:], len(doc)], strict=True):
        # Too few distinct item words can't reach the threshold: no need to tile.
        reach = np.unique(place[a:b][:, None] + np.arange(seeds.min_match)).size
        if reach < coverage * sizes[item[a]]:
            continue
        tiles = tile(word[a:b], place[a:b], seeds.min_match)
        share = sum(t[2] for t in tiles) / int(sizes[item[a]])
        if share >= coverage:
            found.setdefault(int(doc[a]), []).append((int(item[a]), share, tiles))
    return found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list, pa.Array]]:
    """The items in blocks of about BLOCK_WORDS words, one at a time."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    words = items.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    number = max(1, -(-words // BLOCK_WORDS))
    for k in range(number):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k).toPandas()
        yield block["item_id"].tolist(), pa.array(block["text"], pa.large_string())


def _searches(benchmark: DataFrame, min_match: int, item_col: str, text_col: str) -> list:
    sc = ship_package(benchmark.sparkSession).sparkContext
    return [sc.broadcast((ids, Seeds(texts, min_match))) for ids, texts in _blocks(benchmark, item_col, text_col)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE,
                       id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``doc_id`` and ``matches`` (item_id, coverage, tiles in words) of every row; no matches: clean."""
    searches = _searches(benchmark, min_match, item_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    item = benchmark.schema[item_col].dataType.simpleString()
    one = MATCH.format(item=item)
    schema = StructType.fromDDL(f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, matches array<{one}>")
    arrow = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[] for _ in range(batch.num_rows)]
            for s in searches:
                ids, seeds = s.value
                for i, found in matches(batch.column(1), seeds, coverage).items():
                    out[i] += [{"item_id": ids[k], "coverage": share, "tiles": [
                        {"doc_word": d, "item_word": w, "words": n} for d, w, n in tiles]} for k, share, tiles in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, arrow.field(1).type)], schema=arrow)

    return rows.mapInArrow(search, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE,
                      text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows of ``docs``, with all their columns, that cover no item."""
    searches = _searches(benchmark, min_match, item_col, text_col)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            clean = np.ones(batch.num_rows, bool)
            for s in searches:
                clean[list(matches(batch.column(at), s.value[1], coverage))] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)
