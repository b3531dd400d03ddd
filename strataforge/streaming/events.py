"""Windows over events, as batch plans and as streams with the same aggregation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataforge.operators.rounds import shared_folder

LATE = "10 minutes"
GAP = "30 minutes"


def hourly(events: DataFrame) -> DataFrame:
    """Events and values by hour and type; works on streams with a watermark too."""
    hour = F.window("ts", "1 hour")
    return events.groupBy(hour.alias("w"), "event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 2).alias("total")).select(F.col("w.start").alias("hour"), "event_type", "events", "total")


def sessions(events: DataFrame, gap: str = GAP) -> DataFrame:
    """Runs of a user's events with less than the gap between them."""
    return events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("events")).select("user_id", F.col("w.start").alias("session_start"), "events")


def first_events(events: DataFrame) -> DataFrame:
    """The first time of each type and user, however often it repeats."""
    return events.groupBy("event_type", "user_id").agg(F.min("ts").alias("first_ts"), F.count("*").alias("n"))


def deduplicated(events: DataFrame, late: str = LATE) -> DataFrame:
    """A stream without events that repeat an id within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def streamed_hourly(spark: SparkSession, path: str, late: str = LATE) -> DataFrame:
    """Reads a folder or file of events as a stream, aggregates it with a watermark and ends when all is read. Each batch
    replaces what it updates; the last state of an hour is its result."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    source = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder) if name.endswith(".parquet") else spark.readStream.schema(schema).parquet(path)
    kind = schema["ts"].dataType
    made = hourly(source.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late))
    out = f"{shared_folder(spark.range(0))}/stream-{uuid.uuid4().hex}"

    def store(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/rows/n={number}")

    run = made.writeStream.outputMode("update").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).foreachBatch(store).start()
    run.awaitTermination()
    rows = spark.read.parquet(f"{out}/rows")
    return rows.groupBy("hour", "event_type").agg(F.max_by(F.struct("events", "total"), "batch").alias("r")).select(F.col("hour").cast(kind).alias("hour"), "event_type", "r.*")
