import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import near_dup as n
from tallyrisk.llm.components import connected_components
from tallyrisk.llm.linking import spanning_links

from .conftest import prose


def brute(rows, size, similarity):
    """component of every id by all pairs (ids unique)."""
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def changed(rng, text, number):
    w = text.split()
    for k in rng.integers(0, len(w), number):
        w[k] = prose(rng, 1)
    return " ".join(w)


def corpus(seed=0):
    rng = np.random.default_rng(seed)
    rows = [(1000 + i, prose(rng, int(rng.integers(1, 120)))) for i in range(120)]
    base = prose(rng, 150)
    rows += [(100 + i, changed(rng, base, int(rng.integers(0, 12)))) for i in range(150)]  # many near the threshold
    chain = prose(rng, 100)
    for i in range(12):  # neighbours linked, ends not
        rows.append((500 + i, chain))
        chain = changed(rng, chain, 2)
    rows += [(700 + i, "exact Copy of\tthis text " * 3) for i in range(30)] + [(2000, None), (2001, ""), (2002, " \n")]
    rows += [(2100, "two words"), (2101, "Two  words"), (2102, "two"), (2103, "two words more")]
    return rows


@pytest.mark.parametrize("size", [4, 5])
def test_equal_to_all_pairs(spark, make, size):
    rows = corpus()
    expected, numbers = brute(rows, size, 80)
    got = {r["doc_id"]: r for r in n.near_duplicates(make(rows), shingle=size).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == expected
    assert {i: r["n_shingles"] for i, r in got.items()} == numbers
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_small_regions_and_units_find_the_same(spark, make, monkeypatch):
    """Deeper prefixes, parts of crowded regions and confirmation by region."""
    rng = np.random.default_rng(5)
    base = prose(rng, 200)
    rows = [(i, changed(rng, base, int(rng.integers(0, 5)))) for i in range(300)]
    rows += [(1000 + i, prose(rng, 60)) for i in range(50)]
    expected, _ = brute(rows, 5, 80)
    monkeypatch.setattr(n, "REGION", 24)
    monkeypatch.setattr(n, "COMPONENT", 5000)
    got = n.near_duplicates(make(rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected


def test_nulls_repeats_empty_and_extra_columns(spark, make):
    text = "the same words again and again in here"
    docs = make([(None, text), (7, text), (7, text), (3, text + " more"), (None, None), (None, "alone with words here now")])
    docs = docs.withColumnRenamed("source", "node").withColumnRenamed("lang", "region")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in n.near_duplicates(docs, shingle=2).collect()), key=str)
    assert got == sorted([(None, 3, False), (7, 3, False), (7, 3, False), (3, 3, True), (None, None, True),
                          (None, None, True)], key=str)
    assert n.near_duplicates(docs.limit(0)).count() == 0
    kept = n.drop_near_duplicates(docs, shingle=2)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == sorted(
        [("3", text + " more"), ("None", ""), ("None", "alone with words here now")])
    twice = make([(5, text), (5, text), (6, None), (6, None)])
    assert sorted(r["doc_id"] for r in n.drop_near_duplicates(twice).collect()) == [5, 6, 6]


def test_shingle_sets_are_exact():
    texts = ["a b c a b c a b", "", None, "one two", "x " * 50]
    sets, bounds = n.shingle_sets(pa.array(texts), 3)
    assert np.diff(bounds).tolist() == [3, 0, 0, 1, 1]
    keys = n.set_keys(sets, bounds)
    assert keys[1] is None and keys[2] is None and len({keys[0], keys[3], keys[4]}) == 3


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    a, b = prose(rng, 400), None
    b = changed(rng, a, 20)
    sets, bounds = n.shingle_sets(pa.array([a, b]), 4)
    true = len(np.intersect1d(sets[:bounds[1]], sets[bounds[1]:])) / len(np.union1d(sets[:bounds[1]], sets[bounds[1]:]))
    s = n.signatures(sets, bounds)
    assert abs((s[0] == s[1]).mean() - true) < 0.15


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.permutation(4000)[rng.integers(0, 4000, (1500, 2))]]
    edges += [(5000 + i, 5001 + i) for i in range(60)] + [(9000, 9001 + i) for i in range(300)] + [(1, 1)]
    roots = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = collections.defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    assert set(roots) == set(near)
    left = set(near)
    names = set()
    while left:
        part, queue = set(), [left.pop()]
        while queue:
            x = queue.pop()
            if x not in part:
                part.add(x)
                queue += near[x]
        left -= part
        assert len({roots[x] for x in part}) == 1
        assert roots[next(iter(part))] not in names
        names.add(roots[next(iter(part))])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_spanning_links_ask_for_no_pair_twice():
    asked = []

    def linked(i, others):
        asked.extend((i, int(j)) for j in others)
        return others % 3 == i % 3

    edges = spanning_links(30, linked)
    assert len(edges) == 27 and len(asked) == len(set(asked)) < 30 * 29 / 2


def test_query_equals_its_sql(spark, small_dir):
    import duckdb

    from tallyrisk.llm.entries import ORACLE_SQL, QUERIES
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small_dir}/documents.parquet')")
    got = QUERIES["op8_near_dup"](spark, small_dir)
    rows = c.execute(ORACLE_SQL["op8_near_dup"])
    assert got.columns == [d[0] for d in rows.description]
    assert sorted(map(tuple, got.collect())) == sorted(rows.fetchall())


def test_region_fingerprint_never_overflows(spark):
    """Nodes whose hashes are all large: a sum of them leaves the range of a long."""
    nodes = spark.range(3000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("node"))
    nodes = nodes.filter(F.xxhash64("node") > 1 << 62).withColumn("signature", F.array_repeat(F.lit(1), n.TREES * n.DEPTH))
    number = nodes.count()
    assert 600 < number <= n.REGION
    assert n._regions(nodes)[0].select("node").distinct().count() == number


def test_isolated_pairs_of_a_template_family_are_linked(spark, make, monkeypatch):
    """Sets that share most of their shingles, not enough for a link, and a few true pairs among them."""
    rng = np.random.default_rng(8)
    core = prose(rng, 160)
    rows = [(i, core + " " + prose(rng, 30)) for i in range(200)]
    for i in range(100):
        first, last = core.split(), rows[i][1].split()[160:]
        for k in (20 + i % 20, 60 + i % 20, 100 + i % 20, 140):
            first[k] = prose(rng, 1)
        rows.append((1000 + i, " ".join(first + last)))
    expected, _ = brute(rows, 5, 80)
    assert [expected[1000 + i] for i in range(100)] == list(range(100)) and len(set(expected.values())) == 200
    # One tree, and all sets in one region of it: nothing but the exact join finds every pair.
    monkeypatch.setattr(n, "TREES", 1)
    monkeypatch.setattr(n, "LEAST_DEPTH", 0)
    monkeypatch.setattr(n, "REGION", 3)
    monkeypatch.setattr(n, "COMPONENT", 500)
    assert {r["doc_id"]: r["component_id"] for r in n.near_duplicates(make(rows)).collect()} == expected


def test_few_shared_regions_are_broadcast(spark):
    """Regions that several nodes share find their nodes without a shuffle of all nodes' prefixes."""
    rng = np.random.default_rng(5)
    rows = [(bytes([i, i]), rng.integers(0, 9, n.TREES * n.DEPTH).tolist()) for i in range(40)]
    rows += [(bytes([i, 255]), values) for i, (_, values) in enumerate(rows[:10])]
    nodes = spark.createDataFrame(rows, "node binary, signature array<int>")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        regions, crowded = n._regions(nodes)
        plan = regions._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert crowded is None and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    together = {}
    for r in regions.collect():
        together.setdefault(r["region"], set()).add(bytes(r["node"]))
    assert all(any({bytes([i, i]), bytes([i, 255])} <= found for found in together.values()) for i in range(10))
