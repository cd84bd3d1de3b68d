import numpy as np

import corpus_pipeline
from tallyrisk.llm.common import stored

from .conftest import prose


def broken(words, first):
    """Lines of ten words after one of ``first``."""
    cuts = [0, *range(first, len(words), 10), len(words)]
    return "\n".join(" ".join(words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False))


def planted(spark, folder):
    rng = np.random.default_rng(0)
    item = prose(rng, 40)
    line = prose(rng, 15)
    clean = [(i, prose(rng, int(rng.integers(20, 200)))) for i in range(60)]
    near = prose(rng, 150).split()
    rows = clean + [
        (100, "123 456 --"), (101, None), (102, ""),
        (200, prose(rng, 30) + "\n" + line), (201, line + "\n" + prose(rng, 30)), (202, line),
        # Near copies as documents, broken at other places, so that no line of one is like a line of the other.
        (300, broken(near, 10)), (301, broken([*near[:70], "changed", *near[71:]], 5)),
        (400, prose(rng, 30) + " " + item + " " + prose(rng, 30))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {i for i, _ in clean}


def test_stages_take_out_what_they_should(spark, tmp_path):
    clean = planted(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        if name != "packing":
            assert docs.columns == before
            left.append({r["doc_id"] for r in docs.select("doc_id").collect()})
            assert clean <= left[-1], name
    everything = clean | {100, 101, 102, 200, 201, 202, 300, 301, 400}
    assert everything - left[0] == {100, 101, 102}
    assert left[0] - left[1] == {202}
    assert left[1] - left[2] == {301}
    assert left[2] - left[3] == {400}
    pieces = docs.toPandas()
    assert set(pieces["doc_id"]) == left[3]
    assert (pieces.groupby("doc_id")["length"].sum() == pieces.groupby("doc_id")["doc_tokens"].first()).all()
    whole = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    key = ["doc_id", "start", "length", "sequence_id", "offset"]
    assert sorted(whole.groupby("doc_id")["length"].sum().items()) == sorted(pieces.groupby("doc_id")["length"].sum().items())
    assert list(whole.columns) == list(pieces.columns) and set(key) <= set(whole.columns)


def test_stage_names_and_registration(spark):
    import __spark_entry__ as e
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    names = e.queries()
    assert "pipeline" in names
    for k in range(1, 14):
        assert sum(q.startswith(f"op{k}_") for q in names) == 1


def pipeline_of(spark, folder, rows, benchmark=()):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, node string, region long, place int"
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "n", 1, 2) for i, t in rows], kinds).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return corpus_pipeline.run(spark, str(folder))


def test_empty_tables(spark, tmp_path):
    assert pipeline_of(spark, tmp_path, []).count() == 0


def test_repeated_rows_and_clashing_names(spark, tmp_path):
    """Equal rows are one document; other columns of whatever name ride along."""
    rng = np.random.default_rng(4)
    texts = [prose(rng, 60) for _ in range(4)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0])] * 2 + [(9, texts[1])]
    kept = pipeline_of(spark, tmp_path, rows, [(1, None), (2, "")]).toPandas()
    assert set(kept["doc_id"]) == {0, 1, 2, 3}
