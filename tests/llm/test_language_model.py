import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyrisk.llm import language_model as m
from tallyrisk.llm.common import crc_bucket

from .conftest import prose


def corpus(seed=0, number=120):
    """Two kinds of text, so that the words before tell about the next."""
    rng = np.random.default_rng(seed)
    kinds = [[prose(rng, 1, s) for _ in range(60)] for s in (("an", "er", "th"), ("eau", "é", "oi"))]
    rows = [(i, " ".join(rng.choice(kinds[i % 2], rng.integers(5, 80))) + (" Rare" + prose(rng, 1))) for i in range(number)]
    return rows + [(9000, None), (9001, ""), (9002, "unknown words only here"), (9003, " ".join(kinds[0]) * 20)]


def tokens(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [re.sub("[A-Z]", lambda c: c.group().lower(), w) for w in words] + [m.END]


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return rows, {r["doc_id"]: r for r in m.score_documents(docs, crc_bucket("doc_id", 7) == 2).collect()}


def test_base_scores_equal_brute_force(scored):
    rows, got = scored
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    total, types = sum(counts.values()), len(counts)
    for i, t in rows:
        own, r = tokens(t), got[i]
        base = sum(np.log10((counts[w] + 1) / (total + types + 1)) for w in own)
        assert r["held_out"] == held(i) and r["n_tokens"] == len(own) and r["train_tokens"] == total
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        assert np.isclose(r["base_score"], base, atol=1e-8)


def test_model_learns_the_kinds(scored):
    rows, got = scored
    own = [got[i] for i, _ in rows if held(i) and i < 9000]
    assert len(own) > 8
    assert sum(r["score"] for r in own) > 0.95 * sum(r["base_score"] for r in own)  # both negative
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got.values())


def test_scores_do_not_depend_on_the_layout(spark, scored, monkeypatch):
    rows, whole = scored
    monkeypatch.setattr(m, "GROUP_DOCS", 30)
    results = []
    for parts in (1, 5):
        docs = spark.createDataFrame(rows[::-1] if parts > 1 else rows, "doc_id long, text string").repartition(parts)
        results.append({r["doc_id"]: r["score"] for r in m.score_documents(docs, crc_bucket("doc_id", 7) == 2).collect()})
    one, other = results
    assert all(np.isclose(one[i], other[i], rtol=1e-6) for i in one)
    assert any(abs(one[i] - whole[i]["score"]) > 1e-3 for i in one)  # copies were averaged


def test_every_training_document_is_in_one_chunk():
    rng = np.random.default_rng(6)
    groups = np.sort(rng.integers(0, 5, 60))
    docs = [rng.integers(0, 1000, rng.integers(1, 40)).astype("<u2") for _ in groups]
    docs[20] = np.arange(500, dtype="<u2")
    rows = m.pa.RecordBatch.from_arrays([m.pa.array(groups), m.pa.array([d.tobytes() for d in docs], m.pa.binary())],
                                        names=["group", "symbols"])
    got = list(m.chunks(iter([rows.slice(0, 7), rows.slice(7, 0), rows.slice(7)]), most=100))
    assert [d.tolist() for c in got for d in c] == [d.tolist() for d in docs]
    assert all(len(c) == 1 or sum(map(len, c)) <= 100 for c in got)
    at = np.cumsum([0] + [len(c) for c in got])
    assert all(len(set(groups[a:b])) == 1 for a, b in zip(at, at[1:]))


def model(seed=0):
    rng = np.random.default_rng(seed)
    start = m.Model.start(1, rng.integers(0, 50, m.FREQUENT + m.RARE_CLASSES).astype(float))
    return m.Model.from_flat(start.flat() + rng.normal(0, 0.2, len(start.flat())).astype(np.float32))


def test_outputs_are_a_distribution():
    net, h = model(), np.random.default_rng(1).normal(0, 1, (1, m.HIDDEN)).astype(np.float32)
    every = np.arange(m.FREQUENT + m.RARE_CLASSES)
    lp = net.log_probabilities(np.repeat(h, len(every), axis=0), every)
    assert np.isclose(np.exp(lp).sum(), 1, atol=1e-4)


def test_scores_equal_token_by_token():
    net, rng = model(), np.random.default_rng(2)
    lengths = [1, 7, 1, 40, 3]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    symbols = rng.integers(0, m.FREQUENT + m.RARE_CLASSES, bounds[-1])
    extra = rng.normal(0, 1, bounds[-1])
    got = m.document_scores(net, symbols, bounds, extra)
    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
        h, total = np.zeros((1, m.HIDDEN), np.float32), 0.0
        for i in range(a, b):
            if i > a:
                h, _ = net.step(symbols[i - 1:i], h)
            total += net.log_probabilities(h, symbols[i:i + 1])[0] + extra[i]
        assert np.isclose(got[k], total, atol=1e-3)


def test_codes_are_stored_whole_and_in_less_room():
    rng = np.random.default_rng(5)
    codes = np.minimum(rng.zipf(1.3, 50_000), 70_000) - 1
    packer = m.zstandard.ZstdCompressor(level=1)
    row = {"codes": packer.compress(m._planes(codes)), "lengths": packer.compress(np.array([3, 0], "<i4").tobytes())}
    got, lengths = m._unpack(row)
    assert got.tolist() == codes.tolist() and lengths.tolist() == [3, 0]
    assert len(row["codes"]) < 0.95 * len(packer.compress(codes.astype("<i4").tobytes()))
    assert m._unpack({"codes": packer.compress(m._planes(codes[:0])), "lengths": packer.compress(b"")})[0].tolist() == []


def test_gradient_by_differences():
    rng = np.random.default_rng(3)
    target = rng.integers(0, m.FREQUENT + m.RARE_CLASSES, (3, 5))
    fresh = np.zeros((3, 5), bool)
    fresh[:, 0], fresh[1, 3] = True, True
    start = model(4).flat().astype(np.float64)

    def network(values):
        params, at = [], 0
        for shape in m.Model.shapes():
            params.append(values[at:at + int(np.prod(shape))].reshape(shape).copy())
            at += int(np.prod(shape))
        return m.Model(params)

    def loss(values):
        net, h, total = network(values), np.zeros((3, m.HIDDEN)), 0.0
        for t in range(5):
            before = target[:, t - 1] if t else target[:, 0]
            h, _ = net.step(before, h)
            h = h * ~fresh[:, t][:, None]
            total -= net.log_probabilities(h, target[:, t]).sum()
        return total / target.size

    caught = {}

    class Catch:
        def step(self, *grads):
            caught["g"] = np.concatenate([g.ravel() for g in grads])

    net = network(start)
    m._window(net, Catch(), net.params(), target, fresh, target[:, 0], np.zeros((3, m.HIDDEN)))
    g = caught["g"]
    norm = 1.0 if np.linalg.norm(g) < 0.999 else None
    assert norm, "the clip would hide the scale"
    for i in [*np.argsort(-np.abs(g))[:40], *rng.integers(0, len(g), 20)]:
        up, down = start.copy(), start.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        assert np.isclose((loss(up) - loss(down)) / 2e-5, g[i], atol=2e-4), i


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    from pyspark.sql import functions as F
    got = m.score_documents(docs, F.lit(True)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got) == [
        (1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert m.score_documents(docs.limit(0), F.lit(False)).count() == 0
