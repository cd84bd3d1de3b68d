import numpy as np
import pyarrow as pa

from tallyrisk.llm import lines as m

from .conftest import prose


def table(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
    return d[-1]


def test_edit_distance():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a = "".join(rng.choice(list("abcé"), rng.integers(0, 30)))
        b = list(a) if rng.random() < 0.6 else list("".join(rng.choice(list("abcé"), rng.integers(0, 30))))
        for _ in range(rng.integers(0, 5)):
            b.insert(rng.integers(0, len(b) + 1), rng.choice(list("abcé")))
        assert m.edit_distance(a, "".join(b)) == table(a, "".join(b))


def brute(rows, similarity=m.SIMILARITY):
    """Lines to drop of each id (ids unique, ascending), by all pairs of distinct normalised lines."""
    batch = m.Lines(pa.array([t for _, t in rows], pa.large_string()), m.MIN_WORDS)
    texts = [batch.text(i) for i in range(len(batch.owner))]
    bits = batch.simhashes()
    keys, at = np.unique(np.array(texts, dtype=object), return_index=True)
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            close = bin(int(bits[at[i]] ^ bits[at[j]])).count("1") <= m.BITS
            if close and 1 - table(keys[i], keys[j]) / max(len(keys[i]), len(keys[j])) >= similarity - 1e-9:
                root[find(i)] = find(j)
    index = {k: find(i) for i, k in enumerate(keys)}
    seen, out = set(), {i: [] for i, _ in rows}
    for owner, place, text in zip(batch.owner, batch.place, texts, strict=True):
        if index[text] in seen:
            out[rows[owner][0]].append(int(place))
        seen.add(index[text])
    return out


def corpus(seed=1):
    rng = np.random.default_rng(seed)
    shared = [prose(rng, int(rng.integers(5, 40))) for _ in range(12)]
    rows = []
    for i in range(80):
        own = [prose(rng, int(rng.integers(1, 20))) for _ in range(rng.integers(0, 4))]
        for k in rng.integers(0, 12, rng.integers(0, 4)):
            line = shared[k]
            if rng.random() < 0.4:
                w = line.split()
                w[rng.integers(len(w))] += rng.choice(["x", "er", ",", "!!"])
                line = " ".join(w)
            own.insert(rng.integers(0, len(own) + 1), line.upper() if rng.random() < 0.2 else line)
        rows.append((i, "\n".join(own)))
    return rows


def test_equal_to_all_pairs(spark, make):
    rows = corpus()
    expected = brute(rows)
    got = {r["doc_id"]: r for r in m.dedup_lines(make(rows)).collect()}
    assert {i: r["dropped"] for i, r in got.items()} == expected
    assert sum(map(len, expected.values())) > 50
    for i, r in got.items():
        assert len(r["kept_in"]) == len(r["dropped"]) and all(k <= i for k in r["kept_in"])
    for i, t in rows:
        lines = t.split("\n")
        assert got[i]["n_lines"] == len(lines)
        assert got[i]["text"] == "\n".join(x for k, x in enumerate(lines) if k not in expected[i])


def test_crowded_blocks_find_the_same(spark, make, monkeypatch):
    rows = corpus(2)
    expected = brute(rows)
    monkeypatch.setattr(m, "CROWD", 2)
    monkeypatch.setattr(m, "COMPONENT", 3)
    got = {r["doc_id"]: r["dropped"] for r in m.dedup_lines(make(rows)).collect()}
    assert got == expected


def test_short_blank_null_and_repeated(spark, make):
    line = "one line of six words here"
    docs = make([(1, f"short\n\n{line}\nshort"), (2, f"{line}\n{line}."), (2, f"{line}\n{line}."), (None, line), (4, None),
                 (5, ""), (6, "short\nshort")])
    docs = docs.withColumnRenamed("source", "dropped").withColumnRenamed("lang", "line")
    got = sorted(((str(r["doc_id"]), r["dropped"], r["text"]) for r in m.dedup_lines(docs).collect()), key=lambda r: r[:2])
    # An id that is null comes first.
    assert got == sorted([("None", [], line), ("1", [2], "short\n\nshort"), ("2", [0, 1], ""), ("2", [0, 1], ""),
                          ("4", [], None), ("5", [], ""), ("6", [], "short\nshort")], key=lambda r: r[:2])
    kept = m.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    rows = {str(r["doc_id"]): r for r in kept.collect()}
    assert set(rows) == {"None", "1", "4", "5", "6"}
    assert rows["1"]["text"] == "short\n\nshort" and rows["1"]["n_chars"] == 12
    assert rows["4"]["text"] is None
    assert m.dedup_lines(docs.limit(0)).count() == 0


def test_normalised_lines_are_one():
    batch = m.Lines(pa.array(["The first, of 12 lines!", "the  FIRST of 12 lines", "the first of lines 12", "the first of 34 lines"]), 5)
    keys = batch.keys()
    assert keys[0] == keys[1] and len(set(keys)) == 3
    assert batch.text(0) == "the first of 12 lines"


def test_numbers_are_compared_digit_by_digit(spark, make):
    """Rows of numbers of the same shape are no repeats of one another; one digit of many is a small change."""
    rows = [(1, "12 34 56 78 90"), (2, "11 22 33 44 55"), (3, "2021 1.5 2.5 3.5 4.5"), (4, "1999 9.1 8.2 7.3 6.4"),
            (5, "the total of the year was 1234 units"), (6, "the total of the year was 1235 units")]
    got = {r["doc_id"]: r["dropped"] for r in m.dedup_lines(make(rows)).collect()}
    assert got == {1: [], 2: [], 3: [], 4: [], 5: [], 6: [0]}


def test_long_lines_without_spaces_take_part(spark, make):
    line = "中文文本没有空格" * 6
    got = {r["doc_id"]: r["dropped"] for r in m.dedup_lines(make([(1, line + "\nx"), (2, "y\n" + line), (3, "中文"), (4, "中文")])).collect()}
    assert got == {1: [], 2: [1], 3: [], 4: []}


def test_changed_words_are_found_whatever_their_bits(spark, make):
    """Lines with one word of 20 replaced: most differ in more than three bits of the SimHash."""
    rng = np.random.default_rng(11)
    rows, far = [], 0
    for i in range(60):
        words = prose(rng, 20).split()
        other = list(words)
        other[rng.integers(20)] = prose(rng, 1)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
        bits = m.Lines(pa.array([" ".join(words), " ".join(other)]), 5).simhashes()
        far += bin(int(bits[0] ^ bits[1])).count("1") > 3
    assert far > 20
    got = {r["doc_id"]: r["dropped"] for r in m.dedup_lines(make(rows)).collect()}
    assert got == {i: [0] if i % 2 else [] for i in range(120)}


def test_cells_cut_into_pieces_find_the_same(spark, make, monkeypatch):
    """One long word outweighs the rest: equal SimHashes, so all lines share every cell; few pairs are linked."""
    rng = np.random.default_rng(12)
    link, rows = "http" * 10, []
    for i in range(30):
        own = prose(rng, 8).split()
        rows += [(2 * i, " ".join([link, *own])), (2 * i + 1, " ".join([link, *own[:-1], own[-1] + "er"]))]
    expected = brute(rows)
    assert 30 <= sum(map(len, expected.values())) < 45
    monkeypatch.setattr(m, "CROWD", 2)
    monkeypatch.setattr(m, "PART", 4)
    monkeypatch.setattr(m, "COMPONENT", 3)
    assert {r["doc_id"]: r["dropped"] for r in m.dedup_lines(make(rows)).collect()} == expected


def test_every_pair_of_a_crowded_cell_meets(spark, monkeypatch):
    monkeypatch.setattr(m, "CROWD", 2)
    monkeypatch.setattr(m, "PART", 4)
    nodes = spark.createDataFrame([(bytes([i]), 5) for i in range(30)], "node binary, simhash long")
    cells = {}
    for r in m._cells(nodes).collect():
        cells.setdefault(r["region"], set()).add(r["node"][0])
    met = {(a, b) for c in cells.values() for a in c for b in c if a < b}
    assert len(met) == 30 * 29 // 2 and max(map(len, cells.values())) < 15


def test_pairs_of_characters_exclude_no_similar_text():
    rng = np.random.default_rng(21)
    excluded = 0
    for _ in range(3000):
        a = prose(rng, int(rng.integers(1, 12)))
        b = list(a) if rng.random() < 0.7 else list(prose(rng, int(rng.integers(1, 12))))
        for _ in range(rng.integers(0, 12)):
            at = rng.integers(0, len(b) + 1)
            b[at:at + int(rng.integers(0, 2))] = rng.choice(list("abcé "))
        b = "".join(b)
        shared, longer = np.minimum(m.bigrams(a), m.bigrams(b)).sum(), max(len(a), len(b))
        may = m.may_be_similar(np.array([shared]), np.array([longer]), 0.8)[0]
        assert may or not m.similar(a, b, 0.8)
        excluded += not may
    assert excluded > 500


def changed(rng, text, number):
    out = list(text)
    for _ in range(number):
        at, kind = int(rng.integers(len(out) + 1)), rng.random()
        if kind < 0.4 and at < len(out):
            out[at] = rng.choice(list("abé𝄞 "))
        elif kind < 0.7:
            out.insert(at, rng.choice(list("abé𝄞 ")))
        elif at < len(out):
            del out[at]
    return "".join(out)


def test_distances_taken_together_equal_single_ones():
    rng = np.random.default_rng(17)
    for size in (0, 1, 6, 40, 130, 260):
        a = "".join(rng.choice(list("abcd "), size)) if size else ""
        others = [changed(rng, a, int(rng.integers(0, size // 2 + 2))) for _ in range(40)]
        others += ["".join(rng.choice(list("abcd "), n)) for n in (1, size + 1, size + 9)] + ["", a]
        limits = np.array([int(0.2 * max(size, len(o))) for o in others])
        want = [m.edit_distance(a, o) <= n for o, n in zip(others, limits)]
        got = m.within(m.code_points(a), [m.code_points(o) for o in others], limits)
        assert got.tolist() == want and any(want)
        assert [m.edit_distance(a, o, int(n)) <= n for o, n in zip(others, limits)] == want
        assert all(m.alignment_cost(a, o, int(n)) >= m.edit_distance(a, o) for o, n in zip(others, limits))
        assert [m.similar(a, o, 0.8) for o in others] == want


def test_few_single_distances_in_a_large_unit(monkeypatch):
    """Lines that share a passage and are not similar were decided one by one."""
    rng = np.random.default_rng(18)
    passage = "".join(rng.choice(list("abcdefgh "), 120))
    texts = [passage + "".join(rng.choice(list("abcdefgh "), 160)) for _ in range(120)]
    texts += [changed(rng, texts[k], 9) for k in range(40)]
    calls = []
    single = m.edit_distance
    monkeypatch.setattr(m, "edit_distance", lambda *a: calls.append(1) or single(*a))
    schema = m.pa.schema([("a", m.pa.int64()), ("b", m.pa.int64())])
    batch = m.pa.RecordBatch.from_arrays(
        [m.pa.array([b"u"] * len(texts)), m.pa.array(range(len(texts)), m.pa.int64()), m.pa.array([0] * len(texts), m.pa.int64()),
         m.pa.array([bytes(m.MINIMA)] * len(texts)), m.pa.array(texts)], names=["unit", "node", "simhash", "minima", "text"])
    links = {frozenset(p) for b in m._confirmed(iter([batch]), 0.8, schema) for p in zip(b["a"].to_pylist(), b["b"].to_pylist())}
    assert links == {frozenset((k, 120 + k)) for k in range(40)}
    assert len(calls) < 2000  # of 12,720 pairs


def test_lengths_alone_make_no_candidates():
    """Of a cell of lines with equal sketches only those of like length are linked, and all of these hang together."""
    chars = np.array([50, 60, 61, 90, 100, 200])
    cell = pa.RecordBatch.from_arrays(
        [pa.array([7] * 6, pa.int64()), pa.array(range(6), pa.int64()), pa.array(chars, pa.int32()), pa.array([5] * 6, pa.int64())],
        names=["region", "node", "chars", "simhash"])
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("region", pa.binary())])
    out = pa.Table.from_batches(m._near(iter([cell]), ["simhash"], 0.8, schema)).to_pydict()
    group = list(range(6))
    for a, b in zip(out["a"], out["b"], strict=True):
        assert min(chars[a], chars[b]) >= 0.8 * max(chars[a], chars[b])
        group = [group[a] if g == group[b] else g for g in group]
    assert group[0] == group[1] == group[2] and group[3] == group[4] and len(set(group)) == 3
    assert len(set(out["region"])) == 2


def test_characters_of_lines():
    batch = m.Lines(pa.array(["The first, of 12 lines!\n  short\n--\u00c4rger  \u00fcber  drei kleine  Zeilen", None, "\u4e2d" * 50]), 5)
    assert batch.chars.tolist() == [len(batch.text(i)) for i in range(3)] == [21, 29, 50]


def test_lists_of_lines_are_never_broadcast(spark, make):
    """Documents meet their lists of lines by a shuffle, however few these are, so that work grows with the table alone."""
    line = "one line of six words here"
    rows = [(1, f"a\n{line}"), (2, f"{line}\nb"), (2, f"{line}\nb"), (2, f"{line}s"), (None, line), (None, None), (3, None)]
    result = m.dedup_lines(make(rows))
    for df in (result, m.drop_repeated_lines(make(rows))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    got = sorted((str(r["doc_id"]), r["dropped"], str(r["text"])) for r in result.collect())
    assert got == [("1", [1], "a"), ("2", [0], ""), ("2", [0], "b"), ("2", [0], "b"), ("3", [], "None"),
                   ("None", [], "None"), ("None", [], line)]


def confirmed(texts_of_units):
    """Links of units of texts, all of them candidates of each other, as sets of texts."""
    rows = [(f"{u:08d}".encode(), i, x) for u, texts in enumerate(texts_of_units) for i, x in enumerate(texts, 1000 * u)]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([u for u, _, _ in rows]), pa.array([i for _, i, _ in rows], pa.int64()), pa.array([0] * len(rows), pa.int64()),
         pa.array([bytes(m.MINIMA)] * len(rows)), pa.array([x for _, _, x in rows])], names=["unit", "node", "simhash", "minima", "text"])
    text = {i: x for _, i, x in rows}
    return [{text[a], text[b]} for out in m._confirmed(iter([batch]), 0.8, schema)
            for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True)]


def test_pairs_of_small_units_are_decided_together(monkeypatch):
    """Each unit of two lines took an edit distance of its own."""
    rng = np.random.default_rng(31)
    units = []
    for k in range(300):
        words = prose(rng, 30).split()
        other = list(words)
        for _ in range(3 if k % 3 else 18):
            at, to = rng.integers(30, size=2)
            other[at], other[to] = other[to] + "x", other[at]
        units.append([" ".join(words), " ".join(other)])
    want = [set(u) for u in units if m.edit_distance(*u) <= 0.2 * max(map(len, u)) + 1e-9]
    calls, single = [], m.edit_distance
    monkeypatch.setattr(m, "edit_distance", lambda *a: calls.append(1) or single(*a))
    got = confirmed(units)
    assert sorted(map(sorted, got)) == sorted(map(sorted, want)) and 50 < len(want) < 250
    assert len(calls) < 100


def test_many_pairs_at_once_equal_single_ones(monkeypatch):
    """Texts of all lengths, of few and of thousands of different characters, equal, empty and unequal ones."""
    rng = np.random.default_rng(32)
    monkeypatch.setattr(m, "ALONE", 1)
    cjk = [chr(0x4E00 + k) for k in range(3000)]
    first, second, limits = [], [], []
    for k in range(900):
        letters = [list("ab "), list("abcdefghijklmnopqrstuvwxyz é𝄞"), cjk][k % 3]
        size = int(rng.integers(0, 1400 if k % 5 == 0 else 330))
        a = "".join(rng.choice(letters, size)) if size else ""
        share = rng.random() * 0.35
        b = "".join(rng.choice(letters) if rng.random() < share else c for c in a)
        b = changed(rng, b, int(rng.integers(0, 4 + size // 10))) if size else "x" * int(rng.integers(0, 3))
        first.append(a if k % 2 else b)
        second.append(b if k % 2 else a)
        limits.append(int(0.2 * max(len(a), len(b)) + 1e-9) if k % 7 else int(rng.integers(0, 300)))
    limits = np.array(limits)
    want = [m.edit_distance(a, b) <= n for a, b, n in zip(first, second, limits)]
    assert 200 < sum(want) < 700
    assert m.few_edits(first, second, limits).tolist() == want


def test_cells_of_minima_travel_packed(spark):
    """A line took a row for each of its 12 or 28 cells; of a cell of too many lines every two still meet."""
    rng = np.random.default_rng(33)
    one = [m.Lines(pa.array([prose(rng, 20)]), 5).minima()[0].tobytes()] * 12  # all cells of these hold 12 lines
    rest = [row.tobytes() for row in m.Lines(pa.array([prose(rng, int(rng.integers(8, 30))) for _ in range(60)]), 5).minima()]
    rows = [(i, 40 + i, 20 if i % 2 else 10, x, int(rng.integers(-2**62, 2**62))) for i, x in enumerate(one + rest)]
    nodes = spark.createDataFrame(rows, "node long, chars int, words int, minima binary, simhash long").repartition(2)
    crowded, huge, pieces = m._large_cells(nodes, 10**6, 8)
    assert not len(crowded) and len(huge) >= len(m.TRIPLES) and set(pieces.tolist()) >= {3}
    packed = m._groups_of_minima(nodes, 4, huge, pieces).collect()
    assert len(packed) <= 8
    cells = {}
    for r in packed:
        n = len(r["cells"]) // 32
        for region, node in zip(np.frombuffer(r["cells"], np.uint32, n), np.frombuffer(r["cells"], np.int64, n, 8 * n)):
            cells.setdefault(int(region), set()).add(int(node))
    met = {(a, b) for c in cells.values() for a in c for b in c if a < b}
    byte = np.array([np.frombuffer(x, np.uint8) for x in one + rest])
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            same = byte[a] == byte[b]
            both = any(same[list(t)].all() for t in m.TRIPLES) or (
                rows[a][2] <= m.SHORT and rows[b][2] <= m.SHORT and any(same[list(t)].all() for t in m.PAIRS))
            assert not both or (a, b) in met
    assert max(len(c) for c in cells.values()) < 12
