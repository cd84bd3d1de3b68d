import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyrisk.llm import packing as m
from tallyrisk.llm.packing import combinations, encode, pack_documents, plan_tails, solve_nnls, tokenizer_path

from .conftest import prose


def reference_ids(text):
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return [*t.encode(text, add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("text", [
    "", " ", "plain words, and 12 numbers!", "  two  spaces\n\nlines\t tab", "Éa çè ñ ß ü", "don't we'll I'm",
    "日本語 テキスト", "a b c\u0085d", "<|endoftext|> in text", "😀 mixed ☃", "x" * 3000, "\r\n \r\n", "\u001c\u001d|"])
def test_ids_are_those_of_the_tokenizer(text):
    assert encode(text, tokenizer_path()).tolist() == reference_ids(text)


def test_ids_of_random_characters():
    rng = np.random.default_rng(0)
    pools = [(32, 127), (160, 591), (0, 300), (0x370, 0x600)]
    for _ in range(300):
        low, high = pools[rng.integers(len(pools))]
        text = "".join(chr(c) for c in rng.integers(low, high, rng.integers(1, 40)))
        assert encode(text, tokenizer_path()).tolist() == reference_ids(text)


def test_combinations_fill_the_window():
    c = combinations(32)
    assert (c.sum(axis=1) == 32).all() and (np.diff(c, axis=1) >= 0).all()
    brute = {(a, b, 32 - a - b) for a in range(33) for b in range(33) if a <= b <= 32 - a - b}
    assert {tuple(r) for r in c.tolist()} == brute


def test_nnls_reaches_an_exact_solution():
    rng = np.random.default_rng(1)
    combos = combinations(24)
    combos = combos[(combos < 24).all(axis=1)]
    x = np.zeros(len(combos))
    x[rng.choice(len(x), 8, replace=False)] = rng.integers(50, 200, 8)
    histogram = sum(np.bincount(combos[:, j], weights=x, minlength=24) for j in range(3))
    histogram[0] = 0
    got = solve_nnls(combos, histogram, steps=2000)
    back = sum(np.bincount(combos[:, j], weights=got, minlength=24) for j in range(3))
    assert (got >= 0).all() and np.abs(back[1:] - histogram[1:]).max() <= 0.02 * histogram.max()


def check_plan(histogram, window):
    plan, sequences = plan_tails(np.array(histogram), window)
    filled = np.zeros((sequences, window), int)
    used = {}
    for r in plan.itertuples(index=False):
        for k in range(r[1], r[2]):
            filled[r[5] + k - r[1], r[6]:r[6] + r[4]] += 1
            used.setdefault((r[0], k), []).append((r[3], r[4]))
    assert filled.max(initial=0) <= 1
    assert sorted(used) == [(n, k) for n, c in enumerate(histogram) for k in range(c) if n]
    for (n, _), parts in used.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == n
    assert (filled.sum(axis=1) < window).sum() <= 1  # all but one are full
    for row in filled:
        assert (np.diff(row) <= 0).all()  # no gap before the padding


def test_plans_place_every_token_once():
    rng = np.random.default_rng(2)
    check_plan([0] * 32, 32)
    check_plan([0] * 31 + [5], 32)
    check_plan([0, 1000] + [0] * 30, 32)
    for _ in range(10):
        check_plan([0, *rng.integers(0, rng.integers(1, 60), 31).tolist()], 32)


def test_documents(spark, make):
    rng = np.random.default_rng(3)
    texts = [prose(rng, int(n)) for n in rng.integers(0, 300, 60)] + [None, "", "same", "same", prose(rng, 4000)]
    docs = make([*enumerate(texts), (64, texts[64])])  # the longest twice, with one id
    got = pack_documents(docs, window=128).toPandas()
    assert ((got["length"] * 4) == got["ids"].map(len)).all()
    for i, text in enumerate(texts):
        part = got[got["doc_id"] == i].sort_values(["start", "sequence_id"])
        if i == 64:
            part = part.drop_duplicates("start") if len(part) % 2 == 0 else part
            continue
        joined = np.concatenate([np.frombuffer(b, "<u4") for b in part["ids"]])
        assert joined.tolist() == reference_ids(text or "")
        assert (part["doc_tokens"] == len(joined)).all()
    long = got[got["doc_id"] == 64]
    assert long["length"].sum() == 2 * long["doc_tokens"].iloc[0]
    by = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    for _, part in by:
        ends = part["offset"] + part["length"]
        assert part["offset"].tolist() == [0, *ends.tolist()[:-1]]
    sizes = by["length"].sum()
    assert (sizes <= 128).all() and (sizes < 128).sum() <= 1


def test_empty_and_extra_columns(spark, make):
    docs = make([(1, "one text")])
    assert pack_documents(docs.limit(0)).count() == 0
    odd = docs.withColumnRenamed("lang", "sequence_id").withColumnRenamed("source", "file")
    assert pack_documents(odd).count() == 1


def test_tasks_hold_few_documents_at_once(spark, make, monkeypatch):
    seen = []
    stored = m.stored

    def watched(df, name):
        seen.append((name, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        return stored(df, name)

    monkeypatch.setattr(m, "stored", watched)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert m.pack_documents(make([(i, "some words " * 3) for i in range(20)])).count() == 20
    assert dict(seen)["pack-pieces"] == str(m.CUT_ROWS) and dict(seen)["pack-tails"] == before
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
