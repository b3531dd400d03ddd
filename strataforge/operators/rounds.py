"""Iterative plans: each round's state is written to the shared folder, so lineage does not grow and a lost executor costs no
earlier round."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame

_own: dict[str, str] = {}


def shared_folder(df: DataFrame) -> str:
    """spark.checkpoint.dir, or on a single machine without one an own folder. A cluster without one is refused: its executors
    would each write to a disk of their own."""
    spark = df.sparkSession
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="strataforge-rounds-")
    return _own[app]


def new_folder(df: DataFrame, label: str = "round") -> str:
    return f"{shared_folder(df)}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    path = new_folder(df)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*written: DataFrame) -> None:
    """Deletes the files of tables made by kept() that nothing reads any more."""
    for df in written:
        spark = df.sparkSession
        for parent in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
