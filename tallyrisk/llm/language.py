"""Language ID: a linear-chain conditional random field over the words of a text.

Each word is labelled with a language.  State features are its affixes, its
character n-grams and a lexicon (the word itself, and the languages whose
sample texts use it); transitions between neighbours are learned, and
forward-backward gives every word's marginals.  A document's language is the
one with the largest mean marginal over its words that have a letter, which is
its score.

Training: sequences of spans from bounded samples of documents of each
language, one to three languages a sequence, so that switches are seen; the
weights follow the gradient of the conditional log-likelihood.

Scale.  State scores are computed once for each distinct word of a batch;
forward-backward runs over whole texts, all texts of a batch advancing together
and the finished ones leaving.  The corpus is one scan; the weights
(2**16 x languages) and the lexicon of the bounded sample are broadcast.

Defined cases: ``und`` with score 0 for null texts and texts without a letter
(Unicode letters; words are white-space separated) or when nothing could be
learned; with one known language every other text gets it; equal rows are
labelled each for itself; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import Words, hash_strings, ngram_hashes, ship_package, slices
from .training import Adam, labelled_sample

BUCKETS = 1 << 16
UNKNOWN = "und"


def state_features(vocabulary: pa.Array, lexicon: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of all features: n-grams of <word> (1 to 3), affixes (2, 3), the word, its lexicon class."""
    n = len(vocabulary)
    grams, owner = ngram_hashes(vocabulary, 2, 3, BUCKETS, seed=4)
    buckets, words = [grams], [owner]
    everyone = np.arange(n)
    backwards = pc.utf8_reverse(vocabulary)
    for k, (side, length) in enumerate(((vocabulary, 2), (vocabulary, 3), (backwards, 2), (backwards, 3))):
        affix = pc.utf8_slice_codeunits(side, 0, length)
        buckets.append((hash_strings(affix, 11 + k) % np.uint64(BUCKETS)).astype(np.int64))
        words.append(everyone)
    whole = hash_strings(vocabulary, 17)
    buckets.append((whole % np.uint64(BUCKETS)).astype(np.int64))
    words.append(everyone)
    known, label = lexicon
    if len(known):
        at = np.minimum(np.searchsorted(known, whole), len(known) - 1)
        hit = np.flatnonzero(known[at] == whole)
        buckets.append(BUCKETS + label[at[hit]])
        words.append(hit)
    return np.concatenate(buckets).astype(np.int32), np.concatenate(words).astype(np.int32)


def state_scores(vocabulary: pa.Array, weights: np.ndarray, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    bucket, word = state_features(vocabulary, lexicon)
    return np.stack([np.bincount(word, weights=weights[bucket, k], minlength=len(vocabulary))
                     for k in range(weights.shape[1])], axis=1)


def forward_backward(scores: np.ndarray, bounds: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every position, and the expected transition counts.

    ``scores[bounds[i]:bounds[i + 1]]`` are chain i's state scores.  Chains go
    in order of length, so the ones still running are always the first.
    """
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = bounds[:-1][order], lengths[order]
    e = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    move = np.exp(transition).astype(scores.dtype)
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # chains longer than t
    alpha = np.empty_like(e)
    a = np.empty((0, len(move)))
    for t in range(steps):
        at = starts[:active[t]] + t
        a = e[at] if t == 0 else (a[:active[t]] @ move) * e[at]
        a = a / a.sum(axis=1, keepdims=True)
        alpha[at] = a
    beta = np.ones_like(e)
    expected = np.zeros_like(move)
    b = np.empty((0, len(move)))
    for t in range(steps - 2, -1, -1):
        n, m = active[t + 1], len(b)
        after = starts[:n] + t + 1
        if m < n:
            b = np.concatenate([b, np.ones((n - m, len(move)))])
        message = b * e[after]
        b = message @ move.T
        total = (alpha[starts[:n] + t] * b).sum(axis=1, keepdims=True)
        expected += (alpha[starts[:n] + t] / total).T @ message
        b = b / b.sum(axis=1, keepdims=True)
        beta[starts[:n] + t] = b
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    return gamma, expected * move


def fit(texts: list[str], labels: np.ndarray, languages: int, seed: int = 5, sequences: int = 6000,
        batch: int = 100) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """State weights, transitions and the lexicon (word hashes, their language; shared words are left out)."""
    rng = np.random.default_rng(seed)
    words = Words(pa.array(texts, pa.large_string()))
    vocabulary = words.vocabulary
    use = np.zeros((len(vocabulary), languages))
    np.add.at(use, (words.codes, np.repeat(labels, np.diff(words.bounds))), 1)
    share = use.max(axis=1) / np.maximum(use.sum(axis=1), 1)
    listed = np.flatnonzero((use.sum(axis=1) >= 5) & (share >= 0.9))
    hashes = hash_strings(vocabulary, 17)[listed]
    order = np.argsort(hashes)
    lexicon = (hashes[order], use[listed][order].argmax(axis=1))
    by_language = [np.flatnonzero((labels == k) & (np.diff(words.bounds) > 0)) for k in range(languages)]
    usable = [k for k in range(languages) if len(by_language[k])]
    weights = np.zeros((BUCKETS + languages, languages))
    squares = np.full_like(weights, 1e-6)
    transition = np.zeros((languages, languages))
    adam = Adam(transition, rate=0.02)
    for _ in range(sequences // batch):
        positions, gold, bounds = [], [], [0]
        for _ in range(batch):
            size = 0
            for _ in range(rng.integers(1, 4)):
                k = usable[rng.integers(len(usable))]
                d = by_language[k][rng.integers(len(by_language[k]))]
                low, high = words.bounds[d], words.bounds[d + 1]
                start = rng.integers(low, high)
                stop = min(high, start + rng.integers(1, 25))
                positions.append(np.arange(start, stop))
                gold.append(np.full(stop - start, k))
                size += stop - start
            bounds.append(bounds[-1] + size)
        at, y, bounds = np.concatenate(positions), np.concatenate(gold), np.array(bounds)
        some, code = np.unique(words.codes[at], return_inverse=True)
        bucket, word = state_features(vocabulary.take(pa.array(some)), lexicon)
        scores = np.stack([np.bincount(word, weights=weights[bucket, k], minlength=len(some))
                           for k in range(languages)], axis=1)[code]
        gamma, expected = forward_backward(scores, bounds, transition)
        error = gamma.copy()
        error[np.arange(len(y)), y] -= 1
        inside = np.ones(len(y), bool)
        inside[bounds[:-1][bounds[:-1] < len(y)]] = False
        pairs = np.flatnonzero(inside)
        np.add.at(expected, (y[pairs - 1], y[pairs]), -1.0)
        by_word = np.stack([np.bincount(code, weights=error[:, k], minlength=len(some)) for k in range(languages)], axis=1)
        seen, place = np.unique(bucket, return_inverse=True)
        g = np.stack([np.bincount(place, weights=by_word[word, k]) for k in range(languages)], axis=1) / batch
        squares[seen] += g * g
        weights[seen] -= 0.1 * g / np.sqrt(squares[seen])
        adam.step(expected / batch)
    return weights, transition, lexicon


def identify_language(docs: DataFrame, learn_from: Column | None = None, per_label: int = 300,
                      id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``word_counts`` (words of each language) of every row.

    ``learn_from``: condition on ``doc_id`` for the rows to learn from;
    ``per_label`` bounds the documents of each language that the model is fitted on.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).alias("label"))
    model = learn(rows, learn_from, per_label)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"doc_id {kind}, lang_pred string, score double, word_counts map<string,long>")
    arrow = to_arrow_schema(schema)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            names, score, counts = label_texts(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names), pa.array(score), pa.array(counts, arrow.field(3).type)], schema=arrow)

    return rows.select("doc_id", "text").mapInArrow(label, schema)


def drop_unidentified(docs: DataFrame, least: float = 0.3, per_label: int = 300, id_col: str = "doc_id",
                      text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is found with a score of at least ``least``."""
    model = learn(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                              F.col(lang_col).alias("label")), None, per_label)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            names, score, _ = label_texts(batch.column(at), shared.value)
            yield batch.filter(pa.array((np.array(names) != UNKNOWN) & (score >= least)))

    return docs.mapInArrow(keep, docs.schema)


def learn(rows: DataFrame, learn_from: Column | None, per_label: int) -> tuple:
    """(languages, state weights, transitions, lexicon), from rows of doc_id, text, label."""
    ship_package(rows.sparkSession)
    known = rows.select("doc_id", "label").dropna()
    if learn_from is not None:
        known = known.filter(learn_from)
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    sample = labelled_sample(rows.select("doc_id", "text"), known, per_label)
    languages = sorted(set(sample["label"]))
    texts = [t or "" for t in sample["text"]]
    index = {k: i for i, k in enumerate(languages)}
    if not any(t.split() for t in texts):
        return [], None, None, None
    weights, transition, lexicon = fit(texts, np.array([index[k] for k in sample["label"]]), len(languages))
    return languages, weights.astype(np.float32), transition, lexicon


def label_texts(texts: pa.Array, model: tuple) -> tuple[list[str], np.ndarray, list]:
    languages, weights, transition, lexicon = model
    n = len(texts)
    if not languages:
        return [UNKNOWN] * n, np.zeros(n), [[]] * n
    words = Words(texts)
    letters = pc.match_substring_regex(words.vocabulary, r"\p{L}").to_numpy(zero_copy_only=False)
    scores = state_scores(words.vocabulary, weights, lexicon).astype(np.float32)[words.codes]
    gamma, _ = forward_backward(scores, words.bounds, transition)
    counted = letters[words.codes] if len(words.codes) else np.empty(0, bool)
    owner = words.owner()[counted]
    number = np.bincount(owner, minlength=n)
    means = np.stack([np.bincount(owner, weights=gamma[counted, k], minlength=n) for k in range(len(languages))],
                     axis=1) / np.maximum(number, 1)[:, None]
    best = means.argmax(axis=1)
    picked = np.bincount(owner * len(languages) + gamma[counted].argmax(axis=1),
                         minlength=n * len(languages)).reshape(n, -1)
    names = [languages[b] if k else UNKNOWN for b, k in zip(best, number, strict=True)]
    score = np.where(number > 0, np.clip(means[np.arange(n), best], 0, 1), 0.0)
    counts = [[(languages[j], int(r[j])) for j in np.flatnonzero(r)] for r in picked]
    return names, score, counts
