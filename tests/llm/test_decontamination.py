import re

import numpy as np

from tallyrisk.llm import decontamination as d

from .conftest import prose


def brute_tiles(doc, item, least):
    """Greedy string tiling by its definition: longest unmarked common run first (leftmost in the document)."""
    a, b, tiles = [False] * len(doc), [False] * len(item), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles
        tiles.append((i, j, n))
        a[i:i + n] = [True] * n
        b[j:j + n] = [True] * n


def words(text):
    return [w for w in (x.strip(d.PUNCTUATION) for x in re.findall(r"[^\x20\x09-\x0D]+", text.lower())) if w]


def search(spark, docs, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = d.find_contamination(docs, bench, **options).collect()
    return {r["doc_id"]: {m["item_id"]: m for m in r["matches"]} for r in rows}


def test_coverage_equals_brute_force(spark, make):
    rng = np.random.default_rng(0)
    items = [(k, prose(rng, int(rng.integers(5, 30)), ("a", "b", "c"))) for k in range(6)]
    docs = []
    for i in range(40):
        parts = [prose(rng, int(rng.integers(0, 12)), ("a", "b", "c"))]
        for k in rng.integers(0, 6, rng.integers(0, 3)):
            w = items[k][1].split()
            a = int(rng.integers(0, len(w)))
            parts += [" ".join(w[a:]), " ".join(w[:a]), prose(rng, 3)]
        docs.append((i, " ".join(parts)))
    got = search(spark, make(docs), items, min_match=3, coverage=0.3)
    for i, text in docs:
        for k, item in items:
            share = sum(t[2] for t in brute_tiles(words(text), words(item), 3)) / len(words(item))
            assert (k in got[i]) == (share >= 0.3), (i, k)
            if k in got[i]:
                assert abs(got[i][k]["coverage"] - share) < 1e-9


def test_reordered_and_decorated_passages_are_found(spark, make):
    rng = np.random.default_rng(1)
    item = prose(rng, 40).split()
    around = prose(rng, 200)
    whole = " ".join(item)
    swapped = " ".join(item[25:] + ["between"] + item[:25])
    docs = make([(0, around), (1, around + " " + whole.upper() + "."), (2, f"{swapped} {around}"),
                 (3, " | ".join(item)), (4, " ".join(item[:12]) + " " + around), (5, None), (6, "")])
    got = search(spark, docs, [(7, whole), (8, None), (9, "too short"), (10, whole)])
    assert {i for i in got if got[i]} == {1, 2, 3}
    assert set(got[1]) == {7, 10}
    tiles = got[2][7]["tiles"]
    assert [(t["item_word"], t["words"]) for t in tiles] == [(0, 25), (25, 15)]


def test_blocks_of_items_change_nothing(spark, make, monkeypatch):
    rng = np.random.default_rng(2)
    items = [(k, prose(rng, 20)) for k in range(30)]
    docs = make([(i, prose(rng, 30) + " " + items[i % 30][1]) for i in range(60)] + [(99, prose(rng, 50))])
    one = search(spark, docs, items)
    monkeypatch.setattr(d, "BLOCK_WORDS", 100)
    assert search(spark, docs, items) == one
    assert all(i % 30 in one[i] for i in range(60)) and not one[99]


def test_dropping_keeps_columns_and_clean_rows(spark, make):
    rng = np.random.default_rng(3)
    item = prose(rng, 30)
    docs = make([(1, item), (2, prose(rng, 30)), (None, None), (2, prose(rng, 10))]).withColumnRenamed("source", "item_id")
    kept = d.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 2]
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert d.drop_contaminated(docs, nothing).count() == 4
    assert d.drop_contaminated(docs.limit(0), nothing).count() == 0
