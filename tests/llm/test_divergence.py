"""Source divergences against a plain computation in Python integers."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyrisk.llm import divergence
from tallyrisk.llm.divergence import fold, shares, source_divergences
from tallyrisk.llm.entries import op12_divergence

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least=10, best=10):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER)))
            for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        seen, counts = Counter(), defaultdict(Counter)
        for la, source, words in docs:
            if la == lang:
                seen.update(set(words))
                counts[source].update(words)
        kept = [t for t, n in seen.items() if n >= least]
        v = len(kept)

        def given(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * v) for t in kept}

        p = {s: given(c) for s, c in counts.items()}
        q = given(sum(counts.values(), Counter()))
        for s in counts:
            f = lambda a, b: (a - b) ** 2 // (a + b)
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            strong = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", strong, best)):
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


def corpus(seed, n, sources=5):
    rng = np.random.default_rng(seed)
    words = ["the", "Of", "straße", "naïve", "日本語", "x", "Ünder", "z-z", "it's", "a1b"] + [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    weight = 1 / np.arange(1, len(words) + 1)
    return [(" ".join(rng.choice(words, rng.integers(1, 60), p=weight / weight.sum())), "en" if rng.random() < 0.7 else "ß",
             f"src{min(int(rng.exponential(2)), sources - 1)}") for _ in range(n)]


def run(spark, rows, parts=3, **args):
    df = spark.createDataFrame([(i, *r, "t", 1) for i, r in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, term string, count int")
    got = [tuple(r) for r in source_divergences(df.repartition(parts), **args).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_equals_brute_force(spark):
    rows = corpus(1, 400)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("name,value", [("SPILL", 50), ("HELD", 8), ("STEP", 20)])
def test_spills_blocks_and_steps_change_nothing(spark, monkeypatch, name, value):
    """Spilled hashes, sums in blocks of sources, steps of few terms (the workers get the numbers by closure)."""
    rows = corpus(2, 200)
    batches = [b for b in spark.createDataFrame(rows, "text string, lang string, source string").selectExpr(
        "lang", "source", "cast(text as binary) as text").toArrow().to_batches(max_chunksize=40)]

    def totals():
        cells = defaultdict(lambda: [0, 0])
        for b in fold(iter(batches)):
            for r in b.to_pylist():
                cells[r["lang"], r["term"], r["source"]][0] += r["documents"]
                cells[r["lang"], r["term"], r["source"]][1] += r["count"]
        return dict(cells)

    want = totals()
    monkeypatch.setattr(divergence, name, value)
    assert totals() == want


def slice_batch(spark, sources=5):
    rng = np.random.default_rng(5)
    found = rng.integers(0, 4, (300, sources))
    totals = found.sum(axis=0).tolist()
    terms = [(f"t{i:03}".encode(), [(j, int(n)) for j, n in enumerate(row) if n]) for i, row in enumerate(found) if row.any()]
    df = spark.createDataFrame([("en", len(terms), totals, terms[:150]), ("en", len(terms), totals, terms[150:])],
                               "lang string, kept long, totals array<long>, terms array<struct<term:binary,cells:array<struct<place:long,count:long>>>>")
    return df.toArrow().to_batches()


@pytest.mark.parametrize("name,value", [("HELD", 8), ("STEP", 20), ("HELD", 40)])
def test_blocks_of_sources_and_steps_add_up_the_same(spark, monkeypatch, name, value):
    batches = slice_batch(spark)

    def result():
        sums, strong = Counter(), []
        for b in divergence.emit(iter(batches), 3):
            for r in b.to_pylist():
                if r["other"] is not None:
                    sums[r["source"], r["other"]] += r["value"]
                else:
                    strong.append((r["source"], r["term"], r["value"]))
        return sums, sorted(strong)

    want = result()
    monkeypatch.setattr(divergence, name, value)
    assert result() == want


def test_shares_are_exact_for_large_counts():
    counts = [1, 2, 10**9, 3 * 10**12, 9 * 10**15 - 7]
    for c in counts:
        for total in (c, c + 1, 9 * 10**15):
            assert shares(np.array([c]), np.int64(total)).tolist() == [1 + 10**9 * c // total]


def test_nulls_empties_repeats_and_languages_without_terms(spark):
    rows = [(None, None, None), ("", "en", "a"), ("...", "en", "b"), ("word", "fr", "only"), ("rare", "de", "x"), ("Rare", "de", "y")]
    rows += [("Same words here", "en", s) for s in ("a", "a", "b")] * 6 + [("here É é " + "word " * 40000, "en", "c")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert ("de", "x", "pair", "y", 0, 1) in got and not any(r[0] in ("", "fr") for r in got)
    assert run(spark, rows[:2]) == set()
    empty = source_divergences(spark.createDataFrame([], "text string, lang string, source string"))
    assert empty.count() == 0


def test_least_and_best_are_parameters(spark):
    rows = corpus(4, 80)
    assert run(spark, rows, least_documents=2, best=3) == brute(rows, 2, 3)


def test_entry_columns(spark, small_dir):
    got = op12_divergence(spark, small_dir)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                          ("value", "bigint"), ("rank", "int")]
    rows = [(r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    assert {tuple(r) for r in got.collect()} == brute(rows)
