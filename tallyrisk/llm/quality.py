"""Quality rules: exact text statistics and a calibrated logistic regression.

Model: hashed word and character n-gram features (cased), a word's n-grams
weighted equally, a text's words averaged; logistic regression fitted in numpy
on a bounded sample of labelled rows, probabilities calibrated on a held-out
quarter of it, fixed threshold.  The sum over a text is linear, so a batch
needs one number for each distinct word.  Scoring is one scan in Arrow
batches; the weights (2**18 floats) are the only broadcast.

Defined cases: null and empty texts have no words (all counts 0, probability
that of the intercept); a label table that is empty or has one class keeps
everything (probability 1, or 0 where all labels are 0); a document labelled
more than once counts as good only if all its labels are 1; null labels are
left out; equal rows are scored each for itself; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import Words, hash_strings, mix64, ngram_hashes, ship_package, slices, unsliced
from .training import Adam, labelled_sample, platt, segment_sums, sigmoid

BUCKETS = 1 << 18
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_counts(texts: pa.Array) -> tuple[dict[str, np.ndarray], Words]:
    """The exact statistics of each text, and its (cased) words.

    ``n_repeat_words``: words inside 5-word windows that the text has at least
    twice.  Windows are compared by 64-bit hashes within one text.
    """
    texts = pc.fill_null(unsliced(texts).cast(pa.large_string()), "")
    words = Words(texts, lower=False)
    n = len(texts)
    sizes = pc.utf8_length(words.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = words.owner()

    parts = pc.split_pattern(texts, "\n")
    lines = parts.flatten()
    line_owner = np.repeat(np.arange(n), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))
    with_word = pc.binary_length(pc.ascii_trim_whitespace(lines)).to_numpy(zero_copy_only=False) > 0
    line_owner = line_owner[with_word]
    codes = lines.filter(pa.array(with_word)).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = np.unique(line_owner * (int(codes.max()) + 1 if len(codes) else 1) + codes)
    distinct_owner = distinct // (int(codes.max()) + 1 if len(codes) else 1)

    repeats = np.zeros(n, np.int64)
    m = len(words.codes) - 4
    if m > 0:
        h = words.hashes()[words.codes]
        w = mix64(owner[:m].astype(np.uint64) + np.uint64(1))
        for i in range(5):
            w = mix64(w * np.uint64(0x9E3779B97F4A7C15) + h[i:i + m])
        start = np.flatnonzero(owner[:m] == owner[4:])
        order = np.argsort(w[start], kind="stable")
        ranked = w[start][order]
        same = np.zeros(len(ranked) + 1, bool)
        same[1:-1] = ranked[1:] == ranked[:-1]
        twice = start[order[same[1:] | same[:-1]]]
        marks = np.zeros(len(words.codes) + 1, np.int64)
        np.add.at(marks, twice, 1)
        np.add.at(marks, twice + 5, -1)
        repeats = np.bincount(owner, weights=np.cumsum(marks[:-1]) > 0, minlength=n).astype(np.int64)
    return {
        "n_words": np.diff(words.bounds),
        "word_chars": np.bincount(owner, weights=sizes[words.codes], minlength=n).astype(np.int64),
        "n_symbols": pc.count_substring_regex(texts, "[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": np.bincount(line_owner, minlength=n) - np.bincount(distinct_owner, minlength=n),
        "n_repeat_words": repeats,
    }, words


def word_features(vocabulary: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every word, buckets of all n-grams, the word of each n-gram, n-grams of every word."""
    grams, owner = ngram_hashes(vocabulary, 1, 4, buckets)
    whole = (hash_strings(vocabulary, 5) % np.uint64(buckets)).astype(np.int32)
    return whole, grams.astype(np.int32), owner.astype(np.int32), np.bincount(owner, minlength=len(vocabulary))


def word_scores(features: tuple, weights: np.ndarray) -> np.ndarray:
    """A word's own weight and the mean of its n-grams'."""
    whole, grams, owner, number = features
    return weights[whole] + np.bincount(owner, weights=weights[grams], minlength=len(number)) / np.maximum(number, 1)


def text_scores(words: Words, weights: np.ndarray, bias: float) -> np.ndarray:
    """Log-odds of each text; the intercept alone for a text without words."""
    scores = word_scores(word_features(words.vocabulary, len(weights)), weights)
    sums = segment_sums(scores[words.codes], words.bounds)
    return bias + sums / np.maximum(np.diff(words.bounds), 1)


def fit(texts: pa.Array, labels: np.ndarray, buckets: int = BUCKETS, steps: int = 150) -> tuple[np.ndarray, float, float, float]:
    """weights, bias and the calibration a, b; every fourth row is for the calibration."""
    held = np.arange(len(labels)) % 4 == 0
    learn = np.flatnonzero(~held)
    words = Words(texts.take(pa.array(learn)), lower=False)
    y = labels[learn].astype(float)
    features = word_features(words.vocabulary, buckets)
    whole, grams, word, number = features
    owner, size = words.owner(), np.maximum(np.diff(words.bounds), 1)
    balance = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    weights, bias = np.zeros(buckets), np.zeros(1)
    adam = Adam(weights, bias, rate=0.1)
    for _ in range(steps):
        z = bias[0] + segment_sums(word_scores(features, weights)[words.codes], words.bounds) / size
        error = (sigmoid(z) - y) * balance
        by_word = np.bincount(words.codes, weights=(error / size)[owner], minlength=len(words.vocabulary))
        gradient = np.bincount(whole, weights=by_word, minlength=buckets)
        gradient += np.bincount(grams, weights=(by_word / np.maximum(number, 1))[word], minlength=buckets)
        adam.step(gradient + 1e-7 * weights, np.array([error.sum()]))
    rest = np.flatnonzero(held)
    z = text_scores(Words(texts.take(pa.array(rest)), lower=False), weights, bias[0])
    a, b = platt(z, labels[rest])
    return weights, float(bias[0]), a, b


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_label: int = 2000,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The exact counts, ``quality`` (calibrated probability) and ``good`` (quality >= threshold) of every row.

    ``per_label`` bounds the labelled rows of each class that the model is fitted on.
    """
    spark = ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col(id_col).alias("doc_id"), "quality").dropna().groupBy("doc_id").agg(
        (F.min("quality") > 0).cast("int").alias("label"))
    sample = labelled_sample(rows, known, per_label)
    y = sample["label"].to_numpy().astype(int)
    if len(set(y.tolist())) < 2:
        model = (np.zeros(2), 0.0, 0.0, 50.0 if not len(y) or y[0] else -50.0)
    else:
        shuffled = np.random.default_rng(3).permutation(len(y))
        model = fit(pa.array(sample["text"], pa.large_string()).take(pa.array(shuffled)), y[shuffled])
    del sample
    model = (model[0].astype(np.float32), *model[1:])
    shared = spark.sparkContext.broadcast(model)
    schema = StructType.fromDDL(f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                + ", ".join(f"{c} long" for c in COUNTS) + ", quality double, good boolean")
    arrow = to_arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, a, b = shared.value
        for batch in slices(batches):
            counts, words = text_counts(batch.column(1))
            p = sigmoid(a * text_scores(words, weights, bias) + b)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(counts[c], pa.int64()) for c in COUNTS),
                                              pa.array(p), pa.array(p >= threshold)], schema=arrow)

    return rows.mapInArrow(score, schema)
