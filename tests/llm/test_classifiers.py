"""Toxicity, language and quality: held-out accuracy, exact statistics, edge cases."""

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyrisk.llm import language, quality, toxicity
from tallyrisk.llm.common import Words, crc_bucket, hash_strings, ngram_hashes, window_hashes
from tallyrisk.llm.training import platt, sigmoid

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_words_are_those_of_the_pattern():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("aB é \u0085\t\n\x0b\x1c日-"), rng.integers(0, 60))) for _ in range(200)] + [None, ""]
    for array in (pa.array(texts, pa.string()), pa.array(["x", *texts], pa.string()).slice(1)):
        for lower in (False, True):
            w = Words(array, lower=lower)
            names = w.vocabulary.to_pylist()
            for i, t in enumerate(texts):
                expected = WORD.findall(t or "")
                if lower:
                    expected = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in expected]
                assert [names[c] for c in w.codes[w.bounds[i]:w.bounds[i + 1]]] == expected


def test_hashes_depend_on_the_string_alone():
    rng = np.random.default_rng(1)
    values = ["".join(rng.choice(list("abé日"), rng.integers(0, 90))) for _ in range(3000)]
    h = hash_strings(pa.array(values))
    assert len(set(h.tolist())) == len(set(values))
    assert (hash_strings(pa.array(values[::-1]))[::-1] == h).all()
    assert hash_strings(pa.array(values).slice(5)).tolist() == h[5:].tolist()
    assert len(hash_strings(pa.array([], pa.string()))) == 0


def test_windows_stay_inside_texts():
    h = np.arange(1, 8, dtype=np.uint64)
    windows, owner = window_hashes(h, np.array([0, 3, 3, 7]), 2)
    assert owner.tolist() == [0, 0, 2, 2, 2] and len(set(windows.tolist())) == 5
    assert len(window_hashes(h[:1], np.array([0, 1]), 2)[0]) == 0


def test_ngrams():
    grams, owner = ngram_hashes(pa.array(["ab", "", "abc"]), 2, 3, 1 << 40)
    brute = [[f"<{w}>"[i:i + n] for n in (2, 3) for i in range(len(w) + 2 - n + 1)] for w in ("ab", "", "abc")]
    assert np.bincount(owner).tolist() == [len(x) for x in brute]
    names = [g for n in (2, 3) for w in brute for g in w if len(g) == n]
    assert len(set(grams.tolist())) == len(set(names))


def test_calibration_recovers_the_probability():
    rng = np.random.default_rng(2)
    z = rng.normal(0, 2, 20_000)
    y = (rng.random(len(z)) < sigmoid(1.5 * z - 1)).astype(int)
    a, b = platt(z, y)
    assert abs(a - 1.5) < 0.1 and abs(b + 1) < 0.1
    assert platt(z, np.zeros(len(z))) == (1.0, 0.0)


# --- quality ---

def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": repeated, "n_repeat_words": len(covered)}


def test_statistics_equal_brute_force():
    rng = np.random.default_rng(3)
    texts = [None, "", "\n\n", " \n \n", "a b c d e a b c d e", "x " * 200, "line\nline\r\nline\nline "]
    for _ in range(300):
        texts.append("".join(rng.choice(["a", "b", " ", " ", "\n", "é", "#", "|", "word", "\t", "日"], rng.integers(0, 120))))
    got, _ = quality.text_counts(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == brute_counts(t), repr(t)


def labelled(spark, rows, column):
    other = {"quality": "toxic", "toxic": "quality"}[column]
    return spark.createDataFrame([(i, y) for i, y in rows], f"doc_id long, {column} int").withColumn(other, F.lit(0))


def test_quality_on_held_out_rows(spark, make):
    rng = np.random.default_rng(4)
    rows, good = [], {}
    for i in range(500):
        good[i] = int(rng.random() < 0.6)
        w = prose(rng, int(rng.integers(20, 80))).split()
        rows.append((i, " ".join(w) if good[i] else " ".join(x + rng.choice(["###", "%%%", "$$$"]) for x in w)))
    labels = labelled(spark, [(i, good[i]) for i in range(300)] + [(1, None), (None, 1), (0, good[0])], "quality")
    got = {r["doc_id"]: r for r in quality.score_quality(make([*rows, (900, None), (901, "")]), labels).collect()}
    assert np.mean([got[i]["good"] == bool(good[i]) for i in range(300, 500)]) > 0.95
    assert got[900]["n_words"] == 0 and 0 <= got[900]["quality"] <= 1


def test_quality_without_labels_keeps_all(spark, make):
    docs = make([(1, "some words"), (None, None)])
    none = labelled(spark, [], "quality")
    assert [r["good"] for r in quality.score_quality(docs, none).collect()] == [True, True]
    bad = labelled(spark, [(1, 0)], "quality")
    assert not any(r["good"] for r in quality.score_quality(docs, bad).collect())
    assert quality.score_quality(docs.limit(0), none).count() == 0


# --- toxicity ---

def test_toxicity_on_held_out_rows_and_misspellings(spark, make):
    rng = np.random.default_rng(5)
    bad = ["blockhead", "nitwit", "scoundrel", "halfwit"]
    rows, toxic = [], {}
    for i in range(900):
        toxic[i] = int(rng.random() < 0.4)
        w = prose(rng, int(rng.integers(10, 200))).split()
        if toxic[i]:
            for k in rng.integers(0, len(w), max(2, len(w) // 40)):
                w[k] = rng.choice(bad)
        rows.append((i, " ".join(w)))
    rows += [(5000 + k, " ".join([*prose(rng, 20).split(), "blockhaed", "scoundrell", "nittwit"])) for k in range(20)]
    rows += [(6000 + k, prose(rng, 2000)) for k in range(10)] + [(7000, None), (7001, "")]
    labels = labelled(spark, [(i, toxic[i]) for i in range(900)], "toxic")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(make(rows), labels, learn_from=crc_bucket("doc_id", 5) != 0).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 100
    assert np.mean([got[i]["predicted"] == toxic[i] for i in held]) > 0.9
    assert np.mean([got[5000 + k]["predicted"] for k in range(20)]) > 0.6
    assert np.mean([got[6000 + k]["predicted"] for k in range(10)]) < 0.3
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    assert got[7000]["score"] == got[7001]["score"]


def test_toxicity_without_labels(spark, make):
    docs = make([(1, "some words"), (None, None)]).withColumnRenamed("lang", "score")
    none = labelled(spark, [], "toxic")
    assert [r["predicted"] for r in toxicity.score_toxicity(docs, none).collect()] == [0, 0]
    assert toxicity.score_toxicity(docs.limit(0), none).count() == 0


def test_texts_with_a_bucket_by_counting():
    rng = np.random.default_rng(8)
    texts = [prose(rng, int(rng.integers(0, 20))) for _ in range(60)]
    count = collections.Counter()
    for t in texts:
        vocabulary = pa.array(sorted(set(t.split())), pa.large_string())
        count.update(set(toxicity.word_grams(vocabulary)[0].tolist()) if len(vocabulary) else ())
    number = toxicity.texts_with(pa.array(texts, pa.large_string()), chunk=7)
    assert {b: int(number[b]) for b in np.flatnonzero(number)} == dict(count)


def test_texts_unlike_any_learnt_are_not_toxic(spark, make):
    for seed in range(3):
        rng = np.random.default_rng(seed)
        rows, toxic = [], {}
        for i in range(120):
            w = prose(rng, int(rng.integers(10, 100))).split()
            toxic[i] = int(i % 20 == 7)
            if toxic[i]:
                for k in rng.integers(0, len(w), max(2, len(w) // 20)):
                    w[k] = rng.choice(["blockhead", "nitwit"])
            rows.append((i, " ".join(w)))
        rows += [(500, "purple elephants dance quietly tonight"), (501, "trains leave at noon"), (502, None), (503, prose(rng, 30))]
        got = {r["doc_id"]: r for r in toxicity.score_toxicity(make(rows), labelled(spark, list(toxic.items()), "toxic")).collect()}
        assert [got[i]["predicted"] for i in (500, 501, 502, 503)] == [0] * 4, seed
        assert sum(got[i]["predicted"] for i in toxic if not toxic[i]) <= 3, seed


def test_log_odds_equal_word_by_word():
    rng = np.random.default_rng(9)
    texts = [prose(rng, n) for n in (0, 1, 39, 40, 41, 130)] + ["Ünlike WORDS 日本 " * 30]
    odds, bias = rng.normal(0, 1, 1 << 10), -0.7
    expected = []
    for t in texts:
        words = t.split()
        values = []
        for x in words:
            one = pa.array([re.sub("[A-Z]", lambda m: m.group().lower(), x)], pa.large_string())
            values.append(odds[toxicity.word_grams(one, len(odds))[0]].mean())
        parts = [values[i:i + toxicity.SEGMENT] for i in range(0, len(values), toxicity.SEGMENT)] or [[0.0]]
        expected.append(np.log(sum(np.exp(np.mean(p) + bias) for p in parts)))
    got = toxicity.log_odds(toxicity.Words(pa.array(texts, pa.large_string())), odds, bias)
    assert np.allclose(got, expected)


def test_segments_cover_every_word_once():
    cuts, first = toxicity.segments(np.array([0, 0, 5, 90]), 40)
    assert cuts.tolist() == [0, 0, 5, 45, 85, 90] and first.tolist() == [0, 1, 2, 5]
    top, share = toxicity.soft_maximum(np.array([0.0, 1.0, 3.0, 1.0, 2.0]), first)
    assert np.allclose(top, [0, 1, np.log(np.exp([3, 1, 2]).sum())]) and np.allclose(share[2:].sum(), 1)


# --- language ---

def brute_chain(scores, transition):
    """Marginals by summing over all label paths."""
    import itertools
    n, k = scores.shape
    gamma = np.zeros((n, k))
    pairs = np.zeros((k, k))
    total = 0
    for path in itertools.product(range(k), repeat=n):
        w = np.exp(sum(scores[i, y] for i, y in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:])))
        total += w
        for i, y in enumerate(path):
            gamma[i, y] += w
        for a, b in zip(path, path[1:]):
            pairs[a, b] += w
    return gamma / total, pairs / total


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(6)
    bounds = np.array([0, 4, 4, 5, 10])
    scores, transition = rng.normal(0, 1, (10, 3)), rng.normal(0, 1, (3, 3))
    gamma, expected = language.forward_backward(scores, bounds, transition)
    parts = [brute_chain(scores[a:b], transition) for a, b in zip(bounds, bounds[1:]) if b > a]
    assert np.allclose(gamma, np.concatenate([p[0] for p in parts]))
    assert np.allclose(expected, sum(p[1] for p in parts))
    assert language.forward_backward(np.empty((0, 3)), np.array([0, 0]), transition)[0].shape == (0, 3)


SYLLABLES = {"aa": ("an", "er", "th", "on", "re"), "bb": ("eau", "é", "oi", "que", "on"), "cc": ("sch", "ung", "ein", "ü", "er")}


def test_language_on_held_out_and_switched_texts(spark, make):
    rng = np.random.default_rng(7)
    rows, lang = [], {}
    for i in range(400):
        lang[i] = rng.choice(list(SYLLABLES))
        rows.append((i, prose(rng, int(rng.integers(1, 60)), SYLLABLES[lang[i]])))
    mixed = prose(rng, 30, SYLLABLES["aa"]) + " " + prose(rng, 50, SYLLABLES["cc"])
    rows += [(1000, None), (1001, ""), (1002, "123 !! --"), (1003, mixed)]
    got = {r["doc_id"]: r for r in language.identify_language(
        make(rows, lang), learn_from=crc_bucket("doc_id", 4) != 2).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i]["lang_pred"] == lang[i] for i in held]) > 0.95
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1002]["score"] == 0
    assert got[1003]["lang_pred"] == "cc" and abs(got[1003]["word_counts"]["aa"] - 30) <= 5
    kept = language.drop_unidentified(make(rows, lang))
    assert {r["doc_id"] for r in kept.collect()} >= set(range(400)) and kept.filter("doc_id between 1000 and 1002").count() == 0


def test_language_without_labels(spark, make):
    docs = make([(1, "some words"), (None, None)], {}).withColumnRenamed("source", "score")
    assert [r["lang_pred"] for r in language.identify_language(docs).collect()] == ["und", "und"]
    assert language.identify_language(docs.limit(0)).count() == 0
    one = make([(1, "some words"), (2, "other words"), (3, "7")], "en")
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify_language(one).collect()} == {1: "en", 2: "en", 3: "und"}
