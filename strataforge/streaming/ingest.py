"""Files as a stream: new files are converted and normalised once; what was read is remembered in the checkpoint.

A file stream sees new paths only. Changed and removed files are found by the manifest (operators.incremental), which stays
authoritative."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.operators import stages
from strataforge.sources import convert
from strataforge.sources.files import SUPPORTED

SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.readStream.format("binaryFile").schema(SCHEMA).option("recursiveFileLookup", "true").load(folder)
    ext = F.lower(F.regexp_extract("path", "\\.([^./]+)$", 1))
    plain = lambda p: F.regexp_replace(p, "^[A-Za-z0-9]+:/*|^/+", "")
    rel = F.substr(plain(F.col("path")), F.length(plain(F.lit(folder.rstrip("/")))) + 2)
    return files.select(rel.alias("rel_path"), ext.alias("ext"), F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("mtime"), F.sha2("content", 256).alias("sha256"), "content").filter(F.col("ext").isin(*sorted(SUPPORTED)))


def ingest_new(spark: SparkSession, folder: str, documents: str, checkpoint: str, domain: str, topic: str = "general") -> None:
    """Appends the documents of files that came since the last call, each batch exactly once."""
    def store(batch: DataFrame, number: int) -> None:
        made = convert.to_markdown(stages.document_names(batch).drop("source_slug", "doc_stem"))
        converted = f"{documents}_converted/batch={number}"  # also holds the files that failed, with their errors
        made.write.mode("overwrite").parquet(converted)
        rows = spark.read.parquet(converted).filter("error is null").drop("error")
        stages.normalise_documents(rows, domain, topic).write.mode("overwrite").parquet(f"{documents}/batch={number}")

    run = new_files(spark, folder).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store).start()
    run.awaitTermination()
