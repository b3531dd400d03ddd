"""The engine's functions by name in SQL: expressions as SQL functions, planners as table functions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strataforge.operators import textplan


def register(spark: SparkSession) -> None:
    """slug, token_count, hash_vector and cosine run in the JVM; plan_chunks and split_chapters make rows of a text."""
    spark.sql(r"CREATE OR REPLACE TEMPORARY FUNCTION slug(x STRING) RETURNS STRING RETURN coalesce(nullif(regexp_replace(regexp_replace(lower(x), '[^\\p{L}\\p{N}]+', '_'), '^_+|_+$', ''), ''), 'na')")
    spark.sql(r"CREATE OR REPLACE TEMPORARY FUNCTION token_count(x STRING) RETURNS INT RETURN coalesce(regexp_count(x, '(?U)\\S+'), 0)")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION hash_vector(x STRING) RETURNS ARRAY<DOUBLE> RETURN transform(sequence(0, 63), i -> round(cast(conv(substring(concat(sha2(x, 256), sha2(unhex(sha2(x, 256)), 256)), i * 2 + 1, 2), 16, 10) AS INT) / 255D, 6))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION cosine(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE RETURN CASE WHEN size(a) = size(b) AND aggregate(a, 0D, (s, x) -> s + x * x) > 0 AND aggregate(b, 0D, (s, x) -> s + x * x) > 0 "
        "THEN aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x) / (sqrt(aggregate(a, 0D, (s, x) -> s + x * x)) * sqrt(aggregate(b, 0D, (s, x) -> s + x * x))) ELSE 0D END"
    )

    @F.udtf(returnType="sequence int, content string, token_count int, paragraph_start int, paragraph_end int")
    class PlanChunks:
        def eval(self, markdown: str):
            for n, c in enumerate(textplan.plan_chunks(markdown or ""), 1):
                yield n, c.content, c.tokens, c.start, c.end

    @F.udtf(returnType="chapter int, level int, title string, body string, word_count int")
    class SplitChapters:
        def eval(self, body: str):
            for c in textplan.chapters(body or "")[1]:
                yield c.number, c.level, c.title, c.body, c.words

    spark.udtf.register("plan_chunks", PlanChunks)
    spark.udtf.register("split_chapters", SplitChapters)
