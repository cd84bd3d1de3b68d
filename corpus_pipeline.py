"""Training-data pipeline: documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``docs``.

1. language ID: rows without an identifiable language go;
2. line dedup: repeated lines go, and rows of which nothing is left;
3. MinHash near-dedup (5-word shingles, 80 per cent): one row of each group stays;
4. benchmark decontamination: rows that cover a benchmark item go;
5. packing: pieces of token sequences of 1,024.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyrisk.llm.common import read_table, stored
from tallyrisk.llm.decontamination import drop_contaminated
from tallyrisk.llm.language import drop_unidentified
from tallyrisk.llm.lines import drop_repeated_lines
from tallyrisk.llm.near_dup import drop_near_duplicates
from tallyrisk.llm.packing import pack_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_unidentified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, shingle=5, similarity=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, window=1024)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: No SQL expresses the trained, tokenizing and transitive stages; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result stored before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
