"""What the operators share: exact word rules, hold-out remainders, written intermediates, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space and \t \n \v \f \r.
GAPS = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_own_dirs: dict[str, str] = {}


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text as an array; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAPS), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def remainder(identifier: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as the empty text."""
    return F.crc32(F.coalesce(identifier.cast("string"), F.lit("")).cast("binary")) % divisor


def let(value: Column, body) -> Column:
    """Evaluates value once and hands it to body: a lambda's variable is never expanded again."""
    return F.transform(F.array(value), body)[0]


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on a single machine without one an own folder. Raises
    on a cluster without one, where a folder of the driver's would not be seen by the executors."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master.split("[")[0] != "local":
        raise ValueError(f"set spark.checkpoint.dir to a folder that driver and executors share (master {master})")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="strataforge-")
    return _own_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, row_group: int | None = None) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again: lineage ends there and a lost executor costs nothing.
    row_group: bytes after which a row group ends, for tables with large rows, as tasks hold a row group at once."""
    spark = df.sparkSession
    path = new_path(spark, label)
    small = {"parquet.block.size": row_group, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 2, "parquet.enable.dictionary": "false"}
    df.write.options(**small if row_group else {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Deletes the files of a table made by written() that nothing reads any more."""
    spark = df.sparkSession
    parents = {name.rpartition("/")[0] for name in df.inputFiles()}
    for parent in parents:
        path = spark._jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, most_rows: int) -> DataFrame:
    """Marks a written table for broadcast only if a count shows that it has most_rows rows at most; else Spark shuffles and
    splits skewed partitions."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df does not use yet, upper and lower case being the same."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


class Shared:
    """A broadcast object. Its class travels with it, so executors need not have this package; `value` unpacks it once a task."""

    def __init__(self, spark: SparkSession, value: object):
        self.packed, self.unpacked = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self):
        return {"packed": self.packed, "unpacked": None}

    @property
    def value(self):
        if self.unpacked is None:
            self.unpacked = cloudpickle.loads(self.packed.value)
        return self.unpacked
