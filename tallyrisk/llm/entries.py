"""Registered queries of this package: one ``opN_<name>`` an operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .clustering import cluster_vectors
from .common import crc_bucket, read_table
from .decontamination import find_contamination
from .divergence import source_divergences
from .language import identify_language
from .language_model import score_documents
from .lines import dedup_lines
from .near_dup import near_duplicates
from .packing import pack_documents
from .quality import score_quality
from .pages import extract_pages
from .pii import KINDS, find_pii
from .sharding import shard_documents
from .toxicity import score_toxicity


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 8 shards of nearly equal bytes."""
    placed = shard_documents(read_table(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    pieces = pack_documents(read_table(spark, sf_dir, "documents"), window=1024)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that its tiles cover."""
    found = find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("matches") > 0).alias("contaminated"),
        F.sort_array(F.transform("matches", lambda m: m["item_id"])).alias("item_ids"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["coverage"])), F.lit(0.0)).alias("coverage"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one, exactly or nearly."""
    return dedup_lines(read_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "dropped", "kept_in", "text")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learnt from labelled rows outside the held-out fifth."""
    scored = score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                            learn_from=crc_bucket("doc_id", 5) != 0)
    return scored.select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learnt outside the held-out quarter."""
    found = identify_language(read_table(spark, sf_dir, "documents"), learn_from=crc_bucket("doc_id", 4) != 2)
    return found.select("doc_id", (crc_bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log10 probability of every whole text, learnt outside the held-out seventh."""
    return score_documents(read_table(spark, sf_dir, "documents"), held_out=crc_bucket("doc_id", 7) == 2)


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components on 4-word shingles at 80 per cent."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, similarity=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: counts and digest of the patterns' spans, and all spans."""
    found = find_pii(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: ~s["added"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[number(k) for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics, the fixed rules on them, and the classifier's verdict on what passes."""
    scored = score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "quality")


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole embeddings in 16 clusters after 3 rounds."""
    found = cluster_vectors(read_table(spark, sf_dir, "embeddings"), clusters=16, rounds=3, components=64)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source's terms stand from the other sources' and the whole language's."""
    return source_divergences(read_table(spark, sf_dir, "documents"), least_documents=10, best=10)


def op13_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every whole page, by the consensus of its host's pages."""
    return extract_pages(read_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_line_dedup": op4_line_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_language": op6_language,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_near_dup": op8_near_dup,
    "op9_pii": op9_pii,
    "op10_quality": op10_quality,
    "op11_clustering": op11_clustering,
    "op12_divergence": op12_divergence,
    "op13_html": op13_html,
}

# Near duplicates by all pairs that share a shingle, and their transitive closure.
_OP8 = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM w WHERE len(words) > 0) u),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
links AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
          WHERE 100 * p.both >= 80 * (x.size + y.size - p.both)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.size, 0) AS n_shingles, least(d.doc_id, coalesce(least.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(least.b, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.a = d.doc_id
"""

# Every round of the clustering by all distances; floors of quotients in whole numbers.
_ROUND = """
a{i} AS MATERIALIZED (
  SELECT x.n, x.vec_id, x.v, arg_min(c.c, (list_sum(list_transform(range(1, 65), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i]))), c.c)) AS cluster,
         min(list_sum(list_transform(range(1, 65), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i])))) AS distance
  FROM x, c{i} c GROUP BY x.n, x.vec_id, x.v)"""
_MOVE = """
s{i} AS (
  SELECT cluster, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM (SELECT cluster, v, unnest(range(1, 65)) AS i FROM a{i}) u GROUP BY cluster, i),
m{i} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s{i} GROUP BY cluster),
c{j} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON m.cluster = c.c)"""
_OP11 = """
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM x ORDER BY h, v LIMIT 16) f),
""" + ",".join(_ROUND.format(i=i) + "," + _MOVE.format(i=i, j=i + 1) for i in range(3)) + "," + _ROUND.format(i=3) + """
SELECT a.vec_id, a.cluster::INT AS cluster, a.distance::BIGINT AS distance,
       (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(a.distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a3 a JOIN c3 c ON c.c = a.cluster
"""

# Every kept term in every group, absent ones included; all pairs of sources.
_OP12 = """
WITH w AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS found FROM documents),
g AS (SELECT DISTINCT lang, source FROM w),
o AS (SELECT doc, lang, source, unnest(found) AS term FROM w),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
cells AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n,
        (1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v))::HUGEINT AS p
      FROM cells JOIN v USING (lang)),
q AS (SELECT lang, term, (1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v))::HUGEINT AS q
      FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY lang, term) t JOIN v USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM found QUALIFY part = 'pair' OR rank <= 10
"""

# No SQL reads web pages at large; the pages of the given tables have one plain article element each, which this cuts out.
_OP13 = """
WITH a AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1),
           '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM pages),
d AS (SELECT page_id, url, regexp_replace(replace(t, '&quot;', '"'), '&amp;?', '&', 'g') AS t FROM a),
c AS (SELECT page_id, url, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS text FROM d)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM c
"""

# Operators that no SQL expresses (trained, tokenizing, sequential or tiling ones) have none; see tests/llm.
ORACLE_SQL: dict[str, str] = {"op8_near_dup": _OP8, "op11_clustering": _OP11, "op12_divergence": _OP12,
                              "op13_html": _OP13}
