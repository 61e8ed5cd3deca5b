"""The operators over their whole tables, with production parameters, and the SQL for those
that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import contaminated
from tidemark.llm.filter_audit import AUDIT_SQL, filter_audit
from tidemark.llm.licenses import document_paths, scan_licences
from tidemark.llm.line_dedup import line_report
from tidemark.llm.near_dedup import near_classes
from tidemark.llm.packing import pack
from tidemark.llm.quality import selected
from tidemark.llm.secrets import secret_report
from tidemark.llm.suffix_dedup import suffix_dedup
from tidemark.llm.text import read_table
from tidemark.llm.topk import quantise, top_products
from tidemark.llm.token_counts import EDIT_TYPE, apply_edits, build_trees
from tidemark.llm.toxicity import score_toxicity
from tidemark.llm.vocabulary import vocabulary_path
from tidemark.llm.whitening import whiten

PACK_VOCABULARY = "word_bpe_49k.json"
COUNT_VOCABULARY = "byte_bpe_50k.json"

# One edit for each 2000 characters, at places that follow from the id: up to seven
# characters are replaced by one of six strings.
EDITS = """transform(sequence(0L, greatest(length(text) div 2000 - 1, 0)), i -> named_struct(
  'start', pmod(xxhash64(doc_id, i), length(text) + 1L), 'length', pmod(xxhash64(i, doc_id), 8L),
  'text', element_at(array('', ' the', 'x', '\\n\\n', '2024', ' -- '), cast(pmod(xxhash64(doc_id, i, 7), 6L) as int) + 1)))"""


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens."""
    return pack(read_table(spark, sf_dir, "documents"), vocabulary_path(PACK_VOCABULARY))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's verified overlaps with benchmark items."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score."""
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class."""
    classes = near_classes(read_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "copies", "class_size", "kept")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: counts, digest and spans."""
    return secret_report(read_table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence, its own or its directory's."""
    return scan_licences(document_paths(read_table(spark, sf_dir, "documents")))


def op7_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance weight and whether the Gumbel top-k takes it."""
    return selected(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after a set of edits."""
    path = vocabulary_path(COUNT_VOCABULARY)
    trees = build_trees(read_table(spark, sf_dir, "documents"), path).withColumn("edits", F.expr(EDITS).cast(EDIT_TYPE))
    edited = apply_edits(trees, path)
    return edited.select("doc_id", "tokens_before", "tokens_after", "n_edits", "recounted", F.size("leaf_tokens").alias("n_leaves"),
                         F.md5("text").alias("text_md5"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of every 50th vector against all others."""
    vectors = quantise(read_table(spark, sf_dir, "embeddings"))
    return top_products(vectors.filter("vec_id % 50 = 0"), vectors, k=5)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of duplicate lines and the digest of what stays."""
    return line_report(read_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's whitened coordinates on the 8 leading components."""
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its bytes that 50-byte strings of smaller ids cover."""
    return suffix_dedup(read_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents, in all 120 orders, for each language."""
    return filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_harmonic_packing, op2_decontaminate, op3_toxicity, op4_near_dedup, op5_secrets,
    op6_license_scan, op7_quality_resampling, op8_edit_counts, op9_exact_topk, op10_line_dedup,
    op11_whitening, op12_suffix_dedup, op13_filter_audit,
)}

ORACLE: dict[str, str] = {
    "op9_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op13_filter_audit": AUDIT_SQL,
}
