"""LM scoring: a gated recurrent language model with a class-factored softmax.

Tokens are lower-cased words and one end per document.  The most frequent
training words have outputs of their own, grouped into classes of 32: P(word) =
P(class | state) P(word | class, state).  All other words, known or not, fall
into classes by a hash of their last two characters, inside which they follow
the add-one counts of the whole training corpus; so every document gets a
probability, and the corpus counts are part of the model.  The state starts at
zero with a document and is carried through all of it, whatever its length.

Training: truncated backpropagation in numpy (windows of 32 tokens, the state
carried from one to the next) on a bounded sample gives the start; then all
training documents are dealt into groups by a hash of id and words, each group
trains a copy, and the copies are averaged, weighted by their tokens, as one
DataFrame aggregation.  Groups and their order follow from the documents alone,
not from files or partitions.

Scale.  Four passes over the documents' words:
1. Each task turns batches of documents into word codes and a dictionary with
   training counts, stored once.
2. Dictionary rows are summed by word (map-side combined) to the corpus
   counts, and joined back to the batches: a batch gets the counts of its own
   words, so no vocabulary is broadcast or collected.
3. Training documents go to their groups as input symbols, two bytes a word;
   a group trains in chunks of bounded size.
4. Batches meet their counts and are scored; all documents of a batch advance
   together and leave when they end.
Only the model (about 10**5 floats), the frequent words (1,024) and the rare
classes' totals (32) are collected and broadcast.

Defined cases: null and empty texts are the end token alone; without any
training document, N and V are 0, the base score is 0 and the model's score is
the base score; equal rows are scored each for itself; other columns are
ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import Words, ship_package, slices, stored, unsliced
from .training import SLOTS, Adam

#: The end token; a word can't contain a space.
END = " "
CLASS_WORDS = 32
FREQUENT = 1024
RARE_CLASSES = 32
HIDDEN = 24
WINDOW = 32
BATCH_DOCS = 8000
#: States that wait for their probabilities, which are taken together.
WAITING = 16_000
#: Documents of a training group on average, and the symbols at which a group is cut.
GROUP_DOCS = 2500
CHUNK = 2_000_000


def rare_class(words: pa.Array) -> np.ndarray:
    """Class of a word without an output of its own: crc32 of its last two characters."""
    endings = pc.utf8_slice_codeunits(unsliced(words.cast(pa.string())), -2).dictionary_encode()
    classes = np.array([zlib.crc32(e.encode()) % RARE_CLASSES for e in endings.dictionary.to_pylist()], dtype=np.int64)
    return classes[endings.indices.to_numpy(zero_copy_only=False)]


class Model:
    """Parameters of the network.  Inputs 0 to FREQUENT - 1 are the frequent words, then the rare classes."""

    NAMES = ("x", "u", "b", "wc", "bc", "ww", "bw")

    def __init__(self, params: list[np.ndarray]):
        self.x, self.u, self.b, self.wc, self.bc, self.ww, self.bw = params

    @classmethod
    def shapes(cls) -> list[tuple[int, ...]]:
        classes = FREQUENT // CLASS_WORDS + RARE_CLASSES
        return [(FREQUENT + RARE_CLASSES, 3 * HIDDEN), (HIDDEN, 3 * HIDDEN), (3 * HIDDEN,), (HIDDEN, classes), (classes,),
                (FREQUENT, HIDDEN), (FREQUENT,)]

    @classmethod
    def start(cls, seed: int, counts: np.ndarray) -> Model:
        """Small random weights; output biases from the counts of the input symbols."""
        rng = np.random.default_rng(seed)
        params = [rng.normal(0, 0.1, s).astype(np.float32) if len(s) > 1 else np.zeros(s, np.float32) for s in cls.shapes()]
        model = cls(params)
        share = np.log(counts + 1.0)
        model.bw[:] = share[:FREQUENT]
        totals = np.concatenate([counts[:FREQUENT].reshape(-1, CLASS_WORDS).sum(axis=1), counts[FREQUENT:]])
        model.bc[:] = np.log(totals + 1.0)
        return model

    def params(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.NAMES]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.params()])

    @classmethod
    def from_flat(cls, values: np.ndarray) -> Model:
        params, at = [], 0
        for shape in cls.shapes():
            size = int(np.prod(shape))
            params.append(values[at:at + size].reshape(shape).astype(np.float32))
            at += size
        return cls(params)

    def gates(self) -> tuple[np.ndarray, np.ndarray]:
        """Input and state weights by gate (update, reset, new), each gate's contiguous; the bias is added to the inputs,
        and the first two gates are halved for tanh (exactly, as 2 is a power of 2)."""
        x, u = ((w if bias is None else w + bias).reshape(len(w), 3, HIDDEN).transpose(1, 0, 2).copy()
                for w, bias in ((self.x, self.b), (self.u, None)))
        x[:2] *= 0.5
        u[:2] *= 0.5
        return x, u

    def step(self, symbols: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The state after reading ``symbols``."""
        x, u = self.gates()
        new, *gates = advanced(x[:, symbols], u, h)
        return new, tuple(gates)

    def inner_logits(self, states: np.ndarray, words: np.ndarray, parts: list[tuple[slice, slice]]) -> np.ndarray:
        """Within its class, less the largest, the logits of all words, for frequent words in the order of their classes."""
        out = np.empty((len(states), CLASS_WORDS), states.dtype)
        for own, part in parts:
            np.matmul(states[own], self.ww[part].T, out=out[own])
        out += self.bw.reshape(-1, CLASS_WORDS)[words // CLASS_WORDS]
        out -= out.max(axis=1, keepdims=True)
        return out

    def log_probabilities(self, h: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """ln P(symbol | state), the class of a rare symbol standing for all its words."""
        classes = FREQUENT // CLASS_WORDS
        frequent = targets < FREQUENT
        which = np.where(frequent, targets // CLASS_WORDS, targets - (FREQUENT - classes))
        logits = h @ self.wc
        logits += self.bc
        logits -= logits.max(axis=1, keepdims=True)
        out = logits[np.arange(len(h)), which]
        out = (out - np.log(np.exp(logits, out=logits).sum(axis=1))).astype(np.float64)
        rows, parts = by_class(frequent, which)
        words = targets[rows]
        inner = self.inner_logits(h[rows], words, parts)
        found = inner[np.arange(len(rows)), words % CLASS_WORDS]
        found -= np.log(np.exp(inner, out=inner).sum(axis=1))
        out[rows] += found
        return out


def advanced(a: np.ndarray, u: np.ndarray, h: np.ndarray, v: np.ndarray | None = None,
             n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The state after ``h`` (a state a row) and the inputs ``a``, both inputs and ``u`` by gate; and what the gradient
    needs: the gates with the new state's share of ``h``, and the new state before its gate (written to ``v`` and ``n``)."""
    v = np.matmul(h, u, out=v)
    gates = v[:2]
    gates += a[:2]
    np.tanh(gates, out=gates)
    gates += 1.0
    gates *= 0.5
    n = np.multiply(gates[1], v[2], out=n)
    n += a[2]
    np.tanh(n, out=n)
    new = h - n
    new *= gates[0]
    new += n
    return new, v, n


def by_class(frequent: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, list[tuple[slice, slice]]]:
    """Places of the frequent words in the order of their classes; each class's slice of them and of the outputs."""
    rows = np.flatnonzero(frequent)
    own = which[rows].astype(np.int16)
    order = np.argsort(own, kind="stable")
    cuts = np.searchsorted(own[order], np.arange(FREQUENT // CLASS_WORDS + 1)).tolist()
    return rows[order], [(slice(a, b), slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS))
                         for c, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]


def train(model: Model, symbols: np.ndarray, bounds: np.ndarray, epochs: int, streams: int = 32,
          rate: float = 0.01, seed: int = 1) -> Model:
    """Truncated backpropagation: documents (symbols, the last one of each the end) in parallel streams."""
    rng = np.random.default_rng(seed)
    lengths = np.diff(bounds)
    if not len(lengths):
        return model
    params = model.params()
    adam = Adam(*params, rate=rate)
    end = np.zeros(len(symbols) + 1, bool)
    end[bounds[1:]] = True
    for _ in range(epochs):
        order = rng.permutation(len(lengths))
        text = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in order])
        streams_now = max(1, min(streams, len(text) // (2 * WINDOW)))
        steps = len(text) // streams_now
        grid = text[:steps * streams_now].reshape(streams_now, steps)
        target = symbols[grid]
        first = np.isin(grid, bounds[:-1])
        h = np.zeros((streams_now, HIDDEN), np.float32)
        before = target[:, 0]
        for t0 in range(0, steps, WINDOW):
            block = target[:, t0:t0 + WINDOW]
            fresh = first[:, t0:t0 + WINDOW]
            if t0:
                before = target[:, t0 - 1]
            h = _window(model, adam, params, block, fresh, before, h)
    return model


def _window(model: Model, adam: Adam, params: list[np.ndarray], target: np.ndarray, fresh: np.ndarray,
            before: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One window: forward, the gradient through it alone, one update; returns the state after it."""
    streams, steps = target.shape
    classes = FREQUENT // CLASS_WORDS
    inputs = np.concatenate([before[:, None], target[:, :-1]], axis=1)
    x, u = model.gates()
    a = np.take(x, inputs.T.reshape(-1), axis=1).reshape(3, steps, streams, HIDDEN)
    olds = np.empty((steps + 1, streams, HIDDEN), h.dtype)
    olds[0] = h
    vs, ns = np.empty((steps, 3, streams, HIDDEN), h.dtype), np.empty((steps, streams, HIDDEN), h.dtype)
    begun = fresh.any(axis=0).tolist()
    keep = (~fresh.T[:, :, None]).astype(h.dtype)
    for t in range(steps):
        h, _, _ = advanced(a[:, t], u, h, vs[t], ns[t])
        if begun[t]:
            h *= keep[t]  # a document starts from zero
        olds[t + 1] = h
    hs = olds[1:].transpose(1, 0, 2).reshape(-1, HIDDEN)
    y = target.reshape(-1)
    total = len(y)
    frequent = y < FREQUENT
    which = np.where(frequent, y // CLASS_WORDS, classes + y - FREQUENT)
    logits = hs @ model.wc
    logits += model.bc
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits, out=logits)
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(total), which] -= 1
    p /= total
    grads = [np.zeros_like(q) for q in params]
    gx, gu, gb, gwc, gbc, gww, gbw = grads
    gwc += hs.T @ p
    gbc += p.sum(axis=0)
    dh = p @ model.wc.T
    rows, parts = by_class(frequent, which)
    chosen, words = hs[rows], y[rows]
    q = model.inner_logits(chosen, words, parts)
    np.exp(q, out=q)
    q /= q.sum(axis=1, keepdims=True)
    q[np.arange(len(q)), words % CLASS_WORDS] -= 1
    q /= total
    inside = np.empty_like(chosen)
    for own, part in parts:
        np.matmul(q[own].T, chosen[own], out=gww[part])
        np.add.reduce(q[own], axis=0, out=gbw[part])
        np.matmul(q[own], model.ww[part], out=inside[own])
    dh[rows] += inside
    dh = dh.reshape(streams, steps, HIDDEN).transpose(1, 0, 2).copy()
    # Of the window at once: what the gradient of a state is multiplied with for the three gates.
    z, r, vn = vs[:, 0], vs[:, 1], vs[:, 2]
    rest = 1 - z
    by_new = rest * (1 - ns * ns)
    by_update = (olds[:-1] - ns) * z * rest
    by_reset = vn * r * (1 - r)
    dv = np.empty((steps, streams, 3 * HIDDEN), h.dtype)
    dn = np.empty((steps, streams, HIDDEN), h.dtype)
    turned = model.u.T
    back = None
    for t in range(steps - 1, -1, -1):
        d = dh[t]
        if back is not None:
            d += back
        if begun[t]:
            d *= keep[t]
        np.multiply(d, by_new[t], out=dn[t])
        np.multiply(d, by_update[t], out=dv[t, :, :HIDDEN])
        np.multiply(dn[t], by_reset[t], out=dv[t, :, HIDDEN:2 * HIDDEN])
        np.multiply(dn[t], r[t], out=dv[t, :, 2 * HIDDEN:])
        back = dv[t] @ turned
        d *= z[t]
        back += d
    gu += olds[:-1].reshape(-1, HIDDEN).T @ dv.reshape(-1, 3 * HIDDEN)
    dv[:, :, 2 * HIDDEN:] = dn
    flat = dv.reshape(-1, 3 * HIDDEN)
    gb += flat.sum(axis=0)
    read = inputs.T.reshape(-1)
    order = np.argsort(read, kind="stable")
    seen, starts = np.unique(read[order], return_index=True)
    gx[seen] = np.add.reduceat(flat[order], starts, axis=0)
    norm = float(np.sqrt(sum((g * g).sum() for g in grads)))
    if norm > 1.0:
        grads = [g / norm for g in grads]
    adam.step(*grads)
    return h


def document_scores(model: Model, symbols: np.ndarray, bounds: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """ln probability of each document: its symbols, and ``extra`` (ln P(word | rare class)) of every token."""
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = bounds[:-1][order], lengths[order]
    out = np.zeros(len(lengths))
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    x, u = model.gates()
    h = np.zeros((len(sizes), HIDDEN), np.float32)
    hs, first, waiting = [], 0, 0
    for t in range(steps):
        n = active[t]
        if t:
            h, _, _ = advanced(np.take(x, symbols[starts[:n] + (t - 1)], axis=1), u, h[:n])
        hs.append(h)
        waiting += n
        if waiting >= WAITING or t == steps - 1:
            counts = active[first:t + 1]
            who = np.arange(waiting) - np.repeat(np.cumsum(counts) - counts, counts)
            here = starts[who] + np.repeat(np.arange(first, t + 1), counts)
            lp = model.log_probabilities(np.concatenate(hs), symbols[here])
            out += np.bincount(who, weights=lp + extra[here], minlength=len(out))
            hs, first, waiting = [], t + 1, 0
    scores = np.empty(len(out))
    scores[order] = out
    return scores


# --- Spark ----------------------------------------------------------------------

def _encode(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row a batch of documents: ids, lengths, packed codes, dictionary, its training counts."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches, BATCH_DOCS):
        words = Words(batch.column(1))
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        training = np.repeat(~held, np.diff(words.bounds))
        counts = np.bincount(words.codes[training], minlength=len(words.vocabulary))
        yield pa.RecordBatch.from_arrays([
            pa.array([uuid.uuid4().int >> 65], pa.int64()), _one(batch.column(0), schema.field(1)), _one(pa.array(held), schema.field(2)),
            pa.array([packer.compress(np.diff(words.bounds).astype("<i4").tobytes())], pa.binary()),
            pa.array([packer.compress(_planes(words.codes))], pa.binary()),
            _one(words.vocabulary.cast(pa.string()), schema.field(5)), _one(pa.array(counts), schema.field(6))],
            schema=schema)


def _one(values: pa.Array, field: pa.Field) -> pa.Array:
    """All values as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).cast(field.type)


def _planes(codes: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones, and so on: the upper ones, mostly zero, take little room."""
    return np.ascontiguousarray(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Codes and lengths (in words) of a stored batch's documents."""
    reader = zstandard.ZstdDecompressor()
    planes = np.frombuffer(reader.decompress(row["codes"]), np.uint8).reshape(4, -1)
    return (np.ascontiguousarray(planes.T).view("<i4").ravel(),
            np.frombuffer(reader.decompress(row["lengths"]), "<i4").astype(np.int64))


def _with_ends(codes: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(bounds[-1], end, codes.dtype)
    inside = np.ones(len(out), bool)
    inside[bounds[1:] - 1] = False
    out[inside] = codes
    return out, bounds


def _symbols(vocabulary: pa.Array, frequent: pa.Array) -> np.ndarray:
    """Input symbol of every dictionary word, and of the end token in the last place."""
    words = pa.concat_arrays([vocabulary.cast(pa.string()), pa.array([END], pa.string())])
    own = pc.fill_null(pc.index_in(words, value_set=frequent), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    rare = np.flatnonzero(own < 0)
    own[rare] = FREQUENT + rare_class(words.take(pa.array(rare)))
    return own


def score_documents(docs: DataFrame, held_out: Column, sample: int = 400, epochs: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row.

    ``held_out``: condition on ``doc_id`` for the documents not to learn from.
    ``sample`` bounds the training documents of the first fit; afterwards all
    training documents are trained on.
    """
    spark = ship_package(docs.sparkSession)
    sc = spark.sparkContext
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"batch long, ids array<{kind}>, held array<boolean>, lengths binary, codes binary, "
                                "words array<string>, counts array<long>")
    arrow = to_arrow_schema(schema)
    batches = stored(rows.mapInArrow(lambda it: _encode(it, arrow), schema), "lm-batches")

    # Corpus counts of the training tokens.
    entries = batches.select("batch", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "e")).select(
        "batch", "place", F.col("e.words").alias("word"), F.col("e.counts").alias("n"))
    counts = stored(entries.filter(F.col("n") > 0).groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
    documents = rows.filter(~F.col("held_out")).select("doc_id").count()
    known = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, types = int(known[0]) + documents, int(known[1]) + (1 if documents else 0)
    top = counts.orderBy(F.desc("c"), "word").limit(FREQUENT - 1).collect()
    listed = [(END, documents)] + [(r["word"], int(r["c"])) for r in top]
    frequent = pa.array([w for w, _ in listed], pa.string())
    names = spark.createDataFrame([(w,) for w, _ in listed], "word string")
    rare = counts.join(F.broadcast(names), "word", "left_anti").groupBy(
        (F.crc32(F.right("word", F.lit(2)).cast("binary")) % RARE_CLASSES).alias("k")).agg(
        F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    rare_tokens, rare_types = np.zeros(RARE_CLASSES), np.zeros(RARE_CLASSES)
    for r in rare:
        rare_tokens[r["k"]], rare_types[r["k"]] = r["n"], r["v"]

    model = _first_model(rows, listed, rare_tokens, frequent, sample, epochs) if documents else None
    if model is not None:
        model = _averaged(batches, model, sc.broadcast(frequent), max(1, -(-documents // GROUP_DOCS)))
    shared = sc.broadcast((None if model is None else model.flat(), frequent, listed, rare_tokens, rare_types, total, types,
                           documents))

    # A batch's words with their corpus counts, in one row.
    looked = entries.join(counts, "word", "left").groupBy("batch").agg(F.sort_array(F.collect_list(
        F.struct("place", F.coalesce("c", F.lit(0)).alias("c")))).alias("found"))
    looked = looked.select(F.col("batch").alias("batch_r"), F.transform("found", lambda s: s["c"]).alias("found"))
    whole = batches.select("batch", "ids", "held", "lengths", "codes", "words").join(
        looked, F.col("batch") == F.col("batch_r"), "left").select("ids", "held", "lengths", "codes", "words", "found")
    out_schema = StructType.fromDDL(f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                    "base_score double, score double")
    out_arrow = to_arrow_schema(out_schema)

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, frequent, listed, rare_tokens, rare_types, total, types, documents = shared.value
        for part in parts:
            for i in range(part.num_rows):
                yield _scored(part.slice(i, 1), flat, frequent, rare_tokens, rare_types, total, types, documents, out_arrow)

    # A row is a batch of thousands of documents: few at a time.
    return whole.mapInArrow(score, out_schema)


def _scored(part: pa.RecordBatch, flat: np.ndarray | None, frequent: pa.Array, rare_tokens: np.ndarray, rare_types: np.ndarray,
            total: int, types: int, documents: int, schema: pa.Schema) -> pa.RecordBatch:
    row = {"codes": part["codes"][0].as_py(), "lengths": part["lengths"][0].as_py()}
    codes, lengths = _unpack(row)
    found = part["found"][0].values
    c = np.append(np.zeros(0) if found is None else found.to_numpy(zero_copy_only=False), documents).astype(np.float64)
    end = len(c) - 1
    tokens, bounds = _with_ends(codes, lengths, end)
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths + 1)
    base = np.log10((c + 1) / (total + types + 1))
    sums = np.bincount(owner, weights=base[tokens], minlength=len(lengths))
    if flat is None:
        scores = sums
    else:
        symbols = _symbols(part["words"][0].values, frequent)
        k = np.maximum(symbols - FREQUENT, 0)
        inner = np.where(symbols < FREQUENT, 0.0, np.log((c + 1) / (rare_tokens[k] + rare_types[k] + 1)))
        scores = document_scores(Model.from_flat(flat), symbols.astype(np.int16)[tokens], bounds, inner[tokens]) / np.log(10)
    return pa.RecordBatch.from_arrays([
        part["ids"][0].values, part["held"][0].values, pa.array(lengths + 1),
        pa.array(np.bincount(owner, weights=(c > 0)[tokens], minlength=len(lengths)).astype(np.int64)),
        pa.array(np.full(len(lengths), total, np.int64)), pa.array(sums), pa.array(scores)], schema=schema)


def _first_model(rows: DataFrame, listed: list, rare_tokens: np.ndarray, frequent: pa.Array, sample: int, epochs: int) -> Model:
    learn = rows.filter(~F.col("held_out"))
    place = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SLOTS))
    cut = min(SLOTS, int(SLOTS * (sample + 4 * sample ** 0.5) / max(learn.select("doc_id").count(), 1)) + 1)
    texts = learn.filter(place < cut).select(place.alias("place"), "text").orderBy("place", "text").limit(sample).toPandas()
    words = Words(pa.array(texts["text"], pa.large_string()))
    symbols = _symbols(words.vocabulary, frequent)
    tokens, bounds = _with_ends(words.codes, np.diff(words.bounds), len(symbols) - 1)
    counts = np.zeros(FREQUENT + RARE_CLASSES)
    counts[:len(listed)] = [n for _, n in listed]
    counts[FREQUENT:] = rare_tokens
    return train(Model.start(7, counts), symbols[tokens], bounds, epochs)


def _training_symbols(batches: DataFrame, frequent) -> DataFrame:
    """``doc_id`` and ``symbols`` (two bytes each, the end last) of every training document."""
    kind = batches.schema["ids"].dataType.elementType.simpleString()
    schema = StructType.fromDDL(f"doc_id {kind}, symbols binary")
    arrow = to_arrow_schema(schema)

    def symbols_of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                codes, lengths = _unpack({k: part[k][i].as_py() for k in ("codes", "lengths")})
                words = _symbols(part["words"][i].values, frequent.value)
                tokens, bounds = _with_ends(codes, lengths, len(words) - 1)
                values = words[tokens].astype("<u2")
                chosen = np.flatnonzero(~part["held"][i].values.to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([
                    part["ids"][i].values.take(pa.array(chosen)),
                    pa.array([values[bounds[d]:bounds[d + 1]].tobytes() for d in chosen], arrow.field(1).type)], schema=arrow)

    return batches.select("codes", "lengths", "held", "words", "ids").mapInArrow(symbols_of, schema)


def chunks(batches: Iterator[pa.RecordBatch], most: int = CHUNK) -> Iterator[list[np.ndarray]]:
    """The documents of each group of sorted rows (group, symbols), in pieces of ``most`` symbols or one document."""
    now, held, size = None, [], 0
    for batch in batches:
        for group, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            symbols = np.frombuffer(packed.as_py(), "<u2")
            if held and (group != now or size + len(symbols) > most):
                yield held
                held, size = [], 0
            now = group
            held.append(symbols)
            size += len(symbols)
    if held:
        yield held


def _averaged(batches: DataFrame, model: Model, frequent, groups: int) -> Model:
    """The mean, by tokens, of copies that each trained on one group of the training documents."""
    start = batches.sparkSession.sparkContext.broadcast(model.flat())
    place = F.xxhash64("doc_id", "symbols")
    dealt = _training_symbols(batches, frequent).select(F.pmod(place, F.lit(groups)).alias("group"), place.alias("place"), "symbols")
    dealt = dealt.repartition("group").sortWithinPartitions("group", "place", "symbols").select("group", "symbols")

    def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = np.zeros(len(start.value)), 0.0
        for texts in chunks(parts):
            own = np.concatenate(texts).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            copy = train(Model.from_flat(start.value.copy()), own, bounds, 1, streams=128, rate=0.006)
            total += copy.flat() * float(len(own))
            weight += float(len(own))
        if weight:  # one row a task for each parameter
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total), pa.array(np.full(len(total), weight))],
                names=["place", "total", "weight"])

    sums = dealt.mapInArrow(learn, "place int, total double, weight double")
    mean = sums.groupBy("place").agg((F.sum("total") / F.sum("weight")).alias("value")).orderBy("place").toPandas()
    # Rounded, so that the order of the sums leaves no trace.
    return Model.from_flat(mean["value"].to_numpy().round(7)) if len(mean) else model
