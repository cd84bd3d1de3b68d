"""Files read in ranges give the records and rejects of the one-task reader, wherever the ranges are cut."""

import contextlib
import os
import tempfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrisk.schemas import RAW_SCHEMAS
from tallyrisk.sources.quoted_csv import _records, csv_records, ends_open, open_ranges, text_lines
from tallyrisk.sources.raw_files import RAW, REASONS, csv_options, parse, scan_raw_csv, text_schema

SCHEMA = RAW_SCHEMAS["bronze_interactions"]


@contextlib.contextmanager
def ranges(spark, size):
    """Files are cut into ranges of about ``size`` bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def one_task(spark, path):
    raw = spark.read.schema(text_schema(SCHEMA)).options(**csv_options(True)).csv(path)
    return parse(raw.select("*", F.col("_metadata.file_name").alias("source_file")), SCHEMA)


def rows(df):
    return sorted(map(repr, (tuple(r[c] if c != RAW else (None if r[c] is None else sorted(r[c].items(), key=str))
                                   for c in df.columns) for r in df.collect())))


def folder(*texts):
    root = tempfile.mkdtemp(prefix="tallyrisk-quoted-")
    for n, text in enumerate(texts):
        with open(os.path.join(root, f"part{n}.csv"), "w", newline="") as fh:
            fh.write(text)
    return root


HEADER = ",".join(f.name for f in SCHEMA.fields) + "\n"


def line(i, note):
    return f'{i},10,complaint,Phone,7,2024-01-01 10:00:00,12,{note},Resolved,4\n'


NOTES = ["plain", '"one\ntwo"', '"said ""hi"",\nleft\n\n"', '""', "", '"a,b"', 'five" wide', '"x"y', '"' + "long\n" * 40 + '"', '"""\n"""',
         '"tail""\n"', '"crlf\r\nin"', "é ß", '"\n\n\n"']


@pytest.mark.parametrize("size", [37, 100, 331, 5000, 1 << 20])
def test_ranges_give_the_rows_of_one_task(spark, size):
    rng = np.random.default_rng(size)
    texts = [HEADER + "".join(line(n * 1000 + i, NOTES[rng.integers(len(NOTES))]) for i in range(60)) for n in range(2)]
    texts[0] += "7,too,short\n" + line("x", '"no\nnumber"') + "\n\n" + '8,10,"cut ""off"'
    texts.append(HEADER)
    texts.append("")
    root = folder(*texts)
    with ranges(spark, size):
        found = scan_raw_csv(spark, root, SCHEMA)
        want = one_task(spark, root)
        assert rows(found) == rows(want)
        assert found.filter(F.size(REASONS) > 0).count() >= 2
        if size < 1000:
            assert text_lines(spark, root).rdd.getNumPartitions() > 10


@pytest.mark.parametrize("seed", range(6))
def test_any_mixture_of_quotes_commas_and_breaks(spark, seed):
    """Also what no writer makes: quotes in the middle, after end quotes, unclosed ones."""
    rng = np.random.default_rng(seed)
    body = "".join(rng.choice(["a", "b", ",", ",", '"', '""', '",', ',"', "\n", "\n"], 400))
    root = folder("h1,h2\n" + body + "\n")
    options = {k: v for k, v in csv_options(True).items()} | {"maxColumns": 2000}
    texts = "a string, b string, c string, _malformed string"
    want = sorted(map(repr, (tuple(r) for r in spark.read.schema(texts).options(**options).csv(root).collect())))
    for size in (23, 64, 100_000):
        with ranges(spark, size):
            kept = {k: str(v) for k, v in options.items() if k != "header"}
            got = csv_records(spark, root).select(F.from_csv("record", texts, kept).alias("r")).select("r.*")
            assert sorted(map(repr, (tuple(r) for r in got.collect()))) == want


def test_header_over_several_ranges_and_a_record_over_many(spark):
    head = '"inter\naction",' + "x" * 200 + "\n"
    root = folder(head + line(1, '"' + "very long\n" * 100 + '"') + line(2, "b"))
    with ranges(spark, 50):
        got = {r[0].split(",")[0]: r[0] for r in csv_records(spark, root).collect()}
    assert set(got) == {"1", "2"} and got["1"].count("\n") == 100


def test_carriage_returns_end_lines(spark):
    root = folder((HEADER + line(1, "a") + line(2, '"b\nc"')).replace("\n", "\r\n"))
    with ranges(spark, 40):
        assert sorted(r[0].split(",")[0] for r in csv_records(spark, root).collect()) == ["1", "2"]
        assert not csv_records(spark, root).filter(F.col("record").endswith("\r")).count()


def test_states_are_kept_only_where_they_change(spark):
    root = folder(HEADER + "".join(line(i, "plain") for i in range(200)))
    with ranges(spark, 100):
        assert open_ranges(text_lines(spark, root)) == {}


def test_missing_and_empty_paths(spark):
    root = folder("")
    assert csv_records(spark, root).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_records(spark, root + "/nothing")


def test_lines_by_their_ends():
    assert [ends_open(x, False) for x in ('a,"b', '"a"', 'a"b', '"a""', '"a"b"', ',"', '"","', 'x,""', '"a"\r')] == [
        True, False, False, True, False, True, True, False, False]
    assert [ends_open(x, True) for x in ('a"', 'a""', 'a"","', 'a","b', '"', '""', 'a",b"c')] == [
        False, True, False, True, False, True, False]


def test_long_lines_of_quotes_take_linear_time():
    import time
    start = time.time()
    for text in ('"' * 500_001, '"a",' * 200_000 + '"', 'a"b,' * 200_000, '""' * 300_000 + "x"):
        ends_open(text, False), ends_open(text, True)
    assert time.time() - start < 10


def test_a_batch_of_quoted_lines_gives_one_batch_of_records():
    """Also where every record has a quoted line break: no batch a record."""
    lines = [x for i in range(1000) for x in (f'{i},"said ""hi"", left', f'on the {i}",4')]
    n = len(lines)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(lines), pa.array([True] * n), pa.array([1] * n, pa.int64()), pa.array(["f.csv"] * n), pa.array([64] * n, pa.int64())],
        ["line", "quoted", "file", "name", "place"])
    out = list(_records(iter([batch.slice(0, 701), batch.slice(701)]), {}, False))
    assert len(out) == 2
    assert [x for b in out for x in b.column("record").to_pylist()] == ["\n".join(lines[i:i + 2]) for i in range(0, n, 2)]
    assert not list(_records(iter([batch]), {}, True))


def test_a_record_is_split_once_for_all_columns_and_filters(spark):
    root = folder(HEADER + line(1, '"a\nb"'))
    with ranges(spark, 1 << 20):
        found = scan_raw_csv(spark, root, SCHEMA).filter(F.size(REASONS) == 0).select("interaction_id", "notes", "date_time")
        assert [tuple(r)[:2] for r in found.collect()] == [(1, "a\nb")]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_csv(") == 1


def test_whole_numbers_of_every_spelling(spark):
    texts = ["4", "4.0", " 4 ", "+4", "-4.000000", "4.5", "1e3", "2147483648", "2147483648.0", "four", "4.", "NA", "0x4"]
    raw = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "i string, n string").select(
        "n", F.lit(None).cast("string").alias("_malformed"), F.col("i").alias("source_file"))
    rows = {int(r["source_file"]): r for r in parse(raw, T.StructType([T.StructField("n", T.IntegerType())])).collect()}
    assert [rows[i]["n"] for i in range(len(texts))] == [4, 4, 4, 4, -4, None, 1000, None, None, None, 4, None, None]
    bad = [5, 7, 8, 9, 12]
    assert [i for i in range(len(texts)) if rows[i][REASONS]] == bad == [i for i in range(len(texts)) if rows[i][RAW]]
    assert rows[9][REASONS] == ["n: not int"] and rows[9][RAW] == {"n": "four", "line": None}
