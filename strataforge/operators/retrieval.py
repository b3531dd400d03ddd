"""Top-k search over vectors, enrichment, and the prioritised context of an answer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataforge.functions.vectors import cosine_to, hash_vector_of


def score(vectors: DataFrame, query: list[float], vector: str = "vector") -> DataFrame:
    """Adds the cosine to the query, rounded to six digits."""
    return vectors.withColumn("score", F.round(cosine_to(F.col(vector), query), 6))


def top_k(scored: DataFrame, k: int, key: str) -> DataFrame:
    """The k best, ties by key: a heap per task, never a full sort."""
    return scored.orderBy(F.desc("score"), F.col(key)).limit(max(1, k))


def top_k_by(scored: DataFrame, group: str, k: int, key: str) -> DataFrame:
    """The k best of each group. Spark keeps k rows a group and task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("score"), F.col(key)))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= max(1, k))


def search(embeddings: DataFrame, evidence: DataFrame, query: str, k: int = 5, domain: str | None = None, topic: str | None = None) -> DataFrame:
    """Text query -> ranked evidence. Filters reach the scan; the join sees k rows only; of repeated evidence ids the last by
    hash counts; unknown ids keep empty fields."""
    for name, value in (("domain", domain), ("topic", topic)):
        if value is not None:
            embeddings = embeddings.filter(F.col(name) == value)
    best = top_k(score(embeddings, hash_vector_of(query)), k, "embedding_id").select("embedding_id", "chunk_id", "evidence_id", "score")
    fields = evidence.select("evidence_id", F.col("document_id").cast("string").alias("document_id"), "chapter_id", "token_count", "content_preview", "hash_sha256")
    wanted = fields.join(F.broadcast(best.select("evidence_id").distinct()), "evidence_id", "left_semi")  # k rows at most
    last = wanted.groupBy("evidence_id").agg(F.max_by(F.struct("document_id", "chapter_id", "token_count", "content_preview"), "hash_sha256").alias("e"))
    text = lambda c: F.coalesce(F.col(f"e.{c}"), F.lit("")).alias(c)
    return best.join(last, "evidence_id", "left").select("embedding_id", "chunk_id", "evidence_id", "score", text("document_id"), text("chapter_id"), F.coalesce("e.token_count", F.lit(0)).alias("token_count"), text("content_preview"))


def answer_context(layers: list[tuple[str, DataFrame]], k: int = 5) -> DataFrame:
    """layers: (name, rows with id, text and score), best first. Rows of the first layer that has any, up to k, with the
    confidence that its place gives."""
    parts = [df.select("id", "text", "score", F.lit(i).alias("priority"), F.lit(name).alias("layer")) for i, (name, df) in enumerate(layers)]
    every = reduce(DataFrame.unionByName, parts)
    best = every.orderBy("priority", F.desc("score"), "id").limit(k)
    confidence = F.round(F.col("score") * (1 - F.col("priority") / (2.0 * len(layers))), 4)
    return best.withColumn("confidence", confidence)
