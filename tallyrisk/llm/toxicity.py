"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the embeddings of its character n-grams and of itself, a
segment (40 words) the mean of its words, a linear softmax gives each segment
its two logits, and a document takes the soft maximum of its segments' log
odds, so that a few words in a long text count.  Embeddings and softmax are
trained together; an unseen misspelling shares most n-grams with the word it
stands for.  Fitted on a bounded sample of labelled rows, calibrated on a
held-out quarter of it.

Scale.  Embedding and softmax are linear below the soft maximum, so scoring
needs one number for each n-gram bucket: 2**17 floats are broadcast, a batch
computes each distinct word once, and the whole corpus is one scan.

Defined cases: null and empty texts and texts without words get the score of
an empty bag; with no labelled rows or one class the score is that class's
prior (0 without any); a document labelled more than once is toxic if any
label is 1; null labels are left out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import Words, hash_strings, ngram_hashes, ship_package, slices
from .training import Adam, labelled_sample, platt, segment_sums, sigmoid

BUCKETS = 1 << 17
SEGMENT = 40
DIMENSIONS = 8
#: Fixed scale of the averaged bags before the softmax.
GAIN = 40.0
#: An n-gram of n texts of the sample moves n / (n + SHRINK) of its step, one of none stays at zero.
SHRINK = 8.0


def word_grams(vocabulary: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by word: bucket, word, and the number of features of every word."""
    grams, owner = ngram_hashes(vocabulary, 3, 5, buckets, seed=2)
    whole = (hash_strings(vocabulary, 9) % np.uint64(buckets)).astype(np.int64)
    bucket = np.concatenate([whole, grams])
    word = np.concatenate([np.arange(len(vocabulary)), owner])
    return bucket, word, np.bincount(word, minlength=len(vocabulary))


def segments(bounds: np.ndarray, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """Segment bounds and the first segment of every text; a text without words has one empty segment."""
    lengths = np.diff(bounds)
    number = np.maximum(1, -(-lengths // size))
    first = np.concatenate([[0], np.cumsum(number)])
    inner = np.arange(first[-1]) - np.repeat(first[:-1], number)
    starts = np.repeat(bounds[:-1], number) + inner * size
    return np.concatenate([starts, bounds[-1:]]), first


def texts_with(texts: pa.Array, chunk: int = 500) -> np.ndarray:
    """In how many of the texts every bucket occurs."""
    number = np.zeros(BUCKETS, np.int64)
    for low in range(0, len(texts), chunk):
        words = Words(texts.take(pa.array(np.arange(low, min(low + chunk, len(texts))))))
        bucket, word, _ = word_grams(words.vocabulary)
        order = np.argsort(word, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words.vocabulary)))])
        for i in range(len(words)):
            codes = np.unique(words.codes[words.bounds[i]:words.bounds[i + 1]])
            sizes = ends[codes + 1] - ends[codes]
            at = np.repeat(ends[codes] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            number[np.unique(bucket[order[at]])] += 1
    return number


def soft_maximum(z: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log-sum-exp of each text's segments, and each segment's share in it."""
    top = np.maximum.reduceat(z, first[:-1])
    number = np.diff(first)
    e = np.exp(z - np.repeat(top, number))
    total = segment_sums(e, first)
    return top + np.log(total), e / np.repeat(total, number)


def fit(texts: pa.Array, labels: np.ndarray, share: np.ndarray, epochs: int = 6, batch: int = 32,
        rate: float = 0.3, seed: int = 5) -> tuple[np.ndarray, float, float, float]:
    """A log-odds value for every bucket, the bias, and the calibration a, b.

    ``share``: how many rows of the corpus a row of its class stands for.
    """
    rng = np.random.default_rng(seed)
    held = np.zeros(len(labels), bool)  # every fourth row of each label
    for label in (0, 1):
        held[np.flatnonzero(labels == label)[1::4]] = True
    learn = np.flatnonzero(~held)
    embedding = np.zeros((BUCKETS, DIMENSIONS))
    softmax = rng.normal(0, 0.1, (DIMENSIONS, 2))
    toxic = labels[learn].sum()
    bias = np.log(np.array([len(learn) - toxic, toxic]) + 0.5)  # what a text without known n-grams gets
    squares = np.full((BUCKETS, 1), 1e-8)
    adam = Adam(softmax, bias, rate=0.02)
    found = texts_with(texts.take(pa.array(learn)))[:, None]
    trust = found / (found + SHRINK)
    for epoch in range(epochs):
        rng.shuffle(learn)
        for i in range(0, len(learn), batch):
            rows = learn[i:i + batch]
            words = Words(texts.take(pa.array(rows)))
            if not len(words.codes):
                continue
            bucket, word, number = word_grams(words.vocabulary)
            vectors = np.stack([np.bincount(word, weights=embedding[bucket, k], minlength=len(number))
                                for k in range(DIMENSIONS)], axis=1) / number[:, None]
            cuts, first = segments(words.bounds)
            size = np.maximum(np.diff(cuts), 1)
            bags = segment_sums(vectors[words.codes], cuts) / size[:, None]
            logits = GAIN * bags @ softmax + bias
            z, part = soft_maximum(logits[:, 1] - logits[:, 0], first)
            error = (sigmoid(z) - labels[rows]) / len(rows)
            by_segment = np.repeat(error, np.diff(first)) * part
            d = np.stack([-by_segment, by_segment], axis=1)
            d_bag = GAIN * d @ softmax.T / size[:, None]
            of = np.repeat(np.arange(len(size)), np.diff(cuts))
            d_word = np.stack([np.bincount(words.codes, weights=d_bag[of, k], minlength=len(number))
                               for k in range(DIMENSIONS)], axis=1) / number[:, None]
            seen, at = np.unique(bucket, return_inverse=True)
            g = np.stack([np.bincount(at, weights=d_word[word, k]) for k in range(DIMENSIONS)], axis=1)
            squares[seen] += (g * g).mean(axis=1, keepdims=True)
            embedding[seen] -= trust[seen] * rate * g / np.sqrt(squares[seen])
            adam.step(GAIN * bags.T @ d, d.sum(axis=0))
    odds = GAIN * embedding @ (softmax[:, 1] - softmax[:, 0])
    offset = float(bias[1] - bias[0])
    rest = np.flatnonzero(held)
    a, b = platt(squash(log_odds(Words(texts.take(pa.array(rest))), odds, offset)), labels[rest], share[rest])
    return odds, offset, a, b


def squash(z: np.ndarray) -> np.ndarray:
    """Monotone, within +-6: keeps a few mislabelled extremes from flattening the calibration."""
    return z / (1 + np.abs(z) / 6)


def log_odds(words: Words, odds: np.ndarray, bias: float) -> np.ndarray:
    bucket, word, number = word_grams(words.vocabulary, len(odds))
    by_word = np.bincount(word, weights=odds[bucket], minlength=len(number)) / np.maximum(number, 1)
    cuts, first = segments(words.bounds)
    means = segment_sums(by_word[words.codes], cuts) / np.maximum(np.diff(cuts), 1)
    return soft_maximum(means + bias, first)[0] if len(words) else np.empty(0)


def score_toxicity(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, per_label: int = 4000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of every row.

    ``learn_from``: condition on ``doc_id`` for the labelled rows to learn from.
    ``per_label`` bounds the labelled rows of each class that the model is fitted on.
    """
    spark = ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col(id_col).alias("doc_id"), "toxic").dropna()
    if learn_from is not None:
        known = known.filter(learn_from)
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    sample = labelled_sample(rows, known, per_label)
    y = sample["label"].to_numpy().astype(int)
    if len(set(y.tolist())) < 2:
        model = (np.zeros(2), 0.0, 0.0, 50.0 if len(y) and y[0] else -50.0)
    else:
        order = np.random.default_rng(3).permutation(len(y))
        share = np.array([totals[k] / max(1, (y == k).sum()) for k in (0, 1)])
        share /= share.min()
        model = fit(pa.array(sample["text"], pa.large_string()).take(pa.array(order)), y[order], share[y[order]])
    del sample
    shared = spark.sparkContext.broadcast((model[0].astype(np.float32), *model[1:]))
    schema = StructType.fromDDL(f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
    arrow = to_arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, bias, a, b = shared.value
        for batch in slices(batches):
            p = sigmoid(a * squash(log_odds(Words(batch.column(1)), odds, bias)) + b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], schema=arrow)

    return rows.mapInArrow(score, schema)
