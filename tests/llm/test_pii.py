import itertools
import re

import numpy as np

from tallyrisk.llm import pii

from .conftest import prose


def brute_base(text):
    """The rules, written out with plain searches."""
    out = []
    for k, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", r"[0-9]+(?:\.[0-9]+){3}",
                                 r"[0-9](?:[\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if k == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if k == 2:
                odd = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
                if not 12 <= len(digits) <= 19 or (sum(digits[::-2]) + sum(odd)) % 10:
                    continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_brute_force():
    rng = np.random.default_rng(0)
    pieces = ["a.b@c.de", "@", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (678) 555-5272", "+", "é",
              " ", "\n", "12", "-", ".", "x_y+z@h-h.co.uk", "0000000000000", "!!"]
    for _ in range(500):
        text = "".join(rng.choice(pieces, rng.integers(0, 12)))
        assert pii.base_spans(text) == brute_base(text), repr(text)


def paths(segments):
    """All segmentations with all labels."""
    starts = {}
    for k, (i, d) in enumerate(zip(segments.start.tolist(), segments.length.tolist())):
        starts.setdefault(i, []).append((k, d))

    def go(i):
        if i == segments.size:
            yield []
            return
        for k, d in starts[i]:
            for label in range(pii.LABELS) if d == 1 else range(1, pii.LABELS):
                for rest in go(i + d):
                    yield [(k, label), *rest]
    return go(0)


def test_dynamic_programs_equal_all_segmentations():
    rng = np.random.default_rng(1)
    text = "call 55 66 now"
    segments = pii.candidates(text, [m.span() for m in pii.WORD.finditer(text)])
    assert max(segments.length) == 2
    weights = rng.normal(0, 1, (pii.BUCKETS, pii.LABELS))
    move = rng.normal(0, 1, (pii.LABELS + 1, pii.LABELS))
    s = pii.scores(segments, weights)
    gamma, expected, total = pii.marginals(segments, s, move)
    mass, by_segment, by_move, best = 0, np.zeros_like(gamma), np.zeros_like(move), (-np.inf, None)
    for path in paths(segments):
        before, value = pii.LABELS, 0
        for k, label in path:
            value += s[k, label] + move[before, label]
            before = label
        best = max(best, (value, path))
        w = np.exp(value)
        mass += w
        before = pii.LABELS
        for k, label in path:
            by_segment[k, label] += w
            by_move[before, label] += w
            before = label
    assert np.isclose(total, np.log(mass))
    assert np.allclose(gamma, by_segment / mass) and np.allclose(expected, by_move / mass)
    assert pii.decode(segments, s, move) == [(k, y) for k, y in best[1] if y]


def card(rng):
    while True:
        digits = "".join(str(d) for d in rng.integers(0, 10, 16))
        if pii.luhn(digits):
            return digits


def entity(rng, kind):
    n = lambda k: "".join(str(d) for d in rng.integers(0, 10, k))
    return (f"{prose(rng, 1)}.{n(2)}@mail{n(1)}.example.com", ".".join(str(x) for x in rng.integers(1, 255, 4)), card(rng),
            f"+1 ({n(3)}) 555-{n(4)}")[kind]


def corpus(rng, number):
    """Rows, and the entities that went into each."""
    rows, inserted = [], {}
    for i in range(number):
        w = prose(rng, int(rng.integers(5, 60))).split()
        inserted[i] = [entity(rng, int(rng.integers(0, 4))) for _ in range(rng.integers(0, 3))]
        for e in inserted[i]:
            w.insert(int(rng.integers(0, len(w))), e)
        if rng.random() < 0.3:
            w.append(rng.choice(["version 2.0.", "in 2021", f"token = \"{rng.integers(0, 1 << 60):x}\"", "12 items"]))
        rows.append((i, " ".join(w)))
    return rows, inserted


def test_added_spans(spark, make):
    rng = np.random.default_rng(2)
    rows, inserted = corpus(rng, 700)
    missed = {}
    for k in range(60):
        number = card(rng)
        form = [f"({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}", f"{entity(rng, 0)}".replace("@", "(at)"),
                ".".join(number[i:i + 4] for i in (0, 4, 8, 12))][k % 3]
        left, right = prose(rng, 12), prose(rng, 8)
        missed[1000 + k] = (len(left) + 1, len(left) + 1 + len(form))
        rows.append((1000 + k, f"{left} {form} {right}"))
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(make(rows + [(5000, None), (5001, "")])).collect()}
    for i, text in rows:
        assert [(s["start"], s["end"], s["kind"]) for s in got[i] if not s["added"]] == [
            (a, b, pii.KINDS[k]) for a, b, k in brute_base(text)]
    hits = [any((s["start"], s["end"]) == missed[i] for s in got[i]) for i in missed]
    assert np.mean(hits) > 0.8
    extra = [t[s["start"]:s["end"]] for i, t in rows if i < 1000 for s in got[i] if s["added"]]
    wrong = [e for e in extra if not any(e == x or x.endswith(e) for v in inserted.values() for x in v)]
    assert len(wrong) <= 3, wrong  # what is added was put there, but for neighbours that the patterns swallow
    assert got[5000] == [] and got[5001] == []


def test_spelled_out_signs(spark, make):
    rng = np.random.default_rng(7)
    rows, _ = corpus(rng, 290)
    forms = ["jane.roe at example dot com", "jane.roe(at)example.com", "(555) 123-4567"]
    for k, form in enumerate(forms * 5):
        rows.append((1000 + k, f"{prose(rng, 9)} {form}, {prose(rng, 7)}"))
    rows += [(2000 + k, f"{prose(rng, 9)} we met at noon. the dot is {prose(rng, 7)}") for k in range(10)]
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(make(rows)).collect()}
    texts = dict(rows)
    found = [[texts[1000 + k][s["start"]:s["end"]] for s in got[1000 + k]] == [form] for k, form in enumerate(forms * 5)]
    for k, form in enumerate(forms):
        assert np.mean(found[k::3]) >= 0.8, form
    assert not any(got[2000 + k] for k in range(10))


def test_window_sample_is_that_of_least_hash(spark, make):
    rng = np.random.default_rng(8)
    rows = corpus(rng, 80)[0] + [(500, " ".join(f"{prose(rng, 9)} {entity(rng, k % 4)}" for k in range(200)))]
    docs = make(rows + rows[:20]).repartition(6)
    every = {w for _, t in rows for w in ((part, tuple(gold)) for part, gold in pii.gold_windows(t))}
    assert sum(part in rows[-1][1] for part, _ in every) > 100  # also from far inside a long text

    def least(filled):
        return sorted((w for w in every if bool(w[1]) == filled), key=lambda w: pii.xxhash.xxh64_intdigest(w[0].encode()))[:15]

    got = [(part, tuple(gold)) for part, gold in pii.window_sample(docs, 15)]
    assert sorted(got) == sorted(least(True) + least(False))


def test_nothing_to_learn_from(spark, make):
    docs = make([(1, "no digits"), (None, None), (2, "version 2.0.")]).withColumnRenamed("source", "spans")
    assert [r["spans"] for r in pii.find_pii(docs).collect()] == [[], [], []]
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_long_text_without_windows_is_fast():
    assert list(pii.windows("word " * 100_000)) == []
    text = "1 " * 3000
    words = list(itertools.chain(*pii.windows(text)))
    assert len(words) == 3000
