"""Tables of a folder, spread over the cluster where their files are too few for that."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df as it is where its scan has a partition for each core; else dealt out evenly, since a small file with one row group
    would keep all work on one core. A large input always has enough partitions, so it is never shuffled by this."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
