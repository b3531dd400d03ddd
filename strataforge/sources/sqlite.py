"""A vector store of SQLite files, as a Spark data source: format("sqlite_vectors").

A store is one file, or a folder of shards that divide the ids by hash. Reading deals a file out in ranges of rowid and lets SQLite
apply equality on domain, topic and ids, which its indexes serve. Writing keeps every id in the shard of its hash, so a task
has one shard to itself: it brings the shard's next version up to date beside the old one, and the commit puts new versions in
place one after the other; a job that fails leaves the old ones and takes its own away.

Files are opened by path where all executors see them (a local master, or a mounted folder), else they are read and written as a
whole through the store's file system, which shards keep small. Vectors are JSON texts; what is no list of numbers reads as null.
"""

from __future__ import annotations

import json
import sqlite3
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, InputPartition, WriterCommitMessage

TEXTS = ("embedding_id", "chunk_id", "evidence_id", "domain", "topic", "model_version", "source_hash")
SCHEMA = "embedding_id string, chunk_id string, evidence_id string, domain string, topic string, model_version string, source_hash string, vector array<double>"
INDEXED = ("embedding_id", "chunk_id", "domain", "topic")
# The table and its indexes, as other readers of such a file expect them.
TABLE = """CREATE TABLE IF NOT EXISTS embeddings (embedding_id TEXT PRIMARY KEY, chunk_id TEXT NOT NULL, evidence_id TEXT NOT NULL, domain TEXT NOT NULL,
topic TEXT NOT NULL, model_version TEXT NOT NULL, vector_json TEXT NOT NULL, source_hash TEXT NOT NULL)"""
INDEXES = ("CREATE INDEX IF NOT EXISTS idx_embeddings_domain_topic ON embeddings(domain, topic)", "CREATE INDEX IF NOT EXISTS idx_embeddings_chunk_id ON embeddings(chunk_id)")
ENDING = ".sqlite"
#: Rows that a task reads, and rows of an Arrow batch.
RANGE, BATCH = 200_000, 2_000


class Store:
    """Files of a path in any file system that Arrow knows."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.fs, self.base = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        self.base = self.base.rstrip("/")
        self.local = self.fs.type_name == "local"

    def shards(self) -> list[str]:
        """A store's files; none if there is no store yet."""
        from pyarrow import fs

        found = self.fs.get_file_info(self.base)
        if found.type == fs.FileType.File:
            return [self.base]
        listed = self.fs.get_file_info(fs.FileSelector(self.base, allow_not_found=True))
        return sorted(x.path for x in listed if x.type == fs.FileType.File and x.path.endswith(ENDING) and not x.base_name.startswith("."))

    def opened(self, file: str) -> sqlite3.Connection:
        if self.local:
            return sqlite3.connect(f"file:{quote(file)}?mode=ro", uri=True)
        con = sqlite3.connect(":memory:")
        with self.fs.open_input_stream(file) as stream:
            con.deserialize(stream.read())
        return con


@dataclass
class Range(InputPartition):
    file: str
    low: int
    high: int


class VectorReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("rowsPerTask", RANGE))
        self.equal: list[tuple[str, str]] = []

    def pushFilters(self, filters: list[Filter]):
        """Equality on indexed columns goes to SQLite; all else stays with Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in INDEXED and isinstance(f.value, str):
                self.equal.append((f.attribute[0], f.value))
            else:
                yield f

    def where(self) -> tuple[str, list[str]]:
        return "".join(f" AND {c} = ?" for c, _ in self.equal), [v for _, v in self.equal]

    def partitions(self) -> list[InputPartition]:
        store, out = Store(self.path), []
        for file in store.shards():
            con = store.opened(file)
            low, high = con.execute("SELECT min(rowid), max(rowid) FROM embeddings").fetchone()
            con.close()
            if low is not None:
                out += [Range(file, k, min(k + self.size, high + 1)) for k in range(low, high + 1, self.size)]
        return out or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        con = Store(self.path).opened(partition.file)
        clause, values = self.where()
        rows = con.execute(f"SELECT {', '.join(TEXTS)}, vector_json FROM embeddings WHERE rowid >= ? AND rowid < ?{clause}", (partition.low, partition.high, *values))
        while some := rows.fetchmany(BATCH):
            *texts, vectors = zip(*some, strict=True)
            yield pa.record_batch([*(pa.array(map(str, c), pa.string()) for c in texts), pa.array(map(numbers, vectors), pa.list_(pa.float64()))], [*TEXTS, "vector"])
        con.close()


def numbers(text: str) -> list[float] | None:
    try:
        return [float(x) for x in json.loads(text)]
    except (ValueError, TypeError):
        return None


@dataclass
class Made(WriterCommitMessage):
    file: str | None
    shard: int


class VectorWriter(DataSourceArrowWriter):
    """A task's rows all belong to the shard of its number (see write_vectors)."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.shards = options["path"], overwrite, int(options["shards"])
        self.run = uuid.uuid4().hex[:12]

    def name(self, shard: int) -> str:
        return f"part-{shard:05d}-of-{self.shards:05d}{ENDING}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Made:
        store, shard = Store(self.path), TaskContext.get().partitionId()
        con, rows = sqlite3.connect(":memory:"), 0
        old = f"{store.base}/{self.name(shard)}"
        if not self.overwrite and old in store.shards():
            with store.fs.open_input_stream(old) as stream:
                con.deserialize(stream.read())
        con.execute(TABLE)
        for statement in INDEXES:
            con.execute(statement)
        columns = [*TEXTS, "vector_json"]
        put = f"INSERT INTO embeddings ({', '.join(columns)}) VALUES ({', '.join('?' * len(columns))}) ON CONFLICT(embedding_id) DO UPDATE SET {', '.join(f'{c} = excluded.{c}' for c in columns[1:])}"
        for batch in iterator:
            texts = [[x or "" for x in batch.column(c).to_pylist()] for c in TEXTS]
            vectors = [json.dumps(x or []) for x in batch.column("vector").to_pylist()]
            con.executemany(put, zip(*texts, vectors, strict=True))
            rows += batch.num_rows
        con.commit()
        if not rows:
            return Made(None, shard)
        file = f"{store.base}/.{self.name(shard)}.{self.run}.{uuid.uuid4().hex[:8]}"
        store.fs.create_dir(store.base, recursive=True)
        with store.fs.open_output_stream(file) as out:
            out.write(con.serialize())
        con.close()
        return Made(file, shard)

    def commit(self, messages: list[Made | None]) -> None:
        store = Store(self.path)
        made = {f"{store.base}/{self.name(m.shard)}": m.file for m in messages if m and m.file}
        for old in store.shards() if self.overwrite else []:
            if old not in made:
                store.fs.delete_file(old)
        for name, file in made.items():
            store.fs.move(file, name)
        self._sweep(store)

    def abort(self, messages: list[Made | None]) -> None:
        self._sweep(Store(self.path))

    def _sweep(self, store: Store) -> None:
        """Takes away what this job's tasks left, those that failed or ran twice too."""
        from pyarrow import fs

        for x in store.fs.get_file_info(fs.FileSelector(store.base, allow_not_found=True)):
            if x.type == fs.FileType.File and f".{self.run}." in x.base_name:
                store.fs.delete_file(x.path)


class SqliteVectors(DataSource):
    """Options: path, rowsPerTask; for writing shards."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_vectors"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> VectorReader:
        return VectorReader(self.options)

    def writer(self, schema, overwrite: bool) -> VectorWriter:
        return VectorWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteVectors)


def shards_of(path: str) -> int | None:
    """Shards of a store that is there; raises for a single file, which only a reader takes."""
    store = Store(path)
    names = store.shards()
    if names == [store.base]:
        raise ValueError("a store of one file is read only; write to a folder")
    return int(names[0].rpartition("-of-")[2].removesuffix(ENDING)) if names else None


def write_vectors(embeddings: DataFrame, path: str, shards: int = 16, overwrite: bool = False) -> None:
    """Rows by embedding_id into a store's shards; rows whose id is there are replaced. Of several rows of an id the last by hash
    counts. A store keeps the number of shards that it was made with."""
    register(embeddings.sparkSession)
    shards = (None if overwrite else shards_of(path)) or shards
    rest = [f.split()[0] for f in SCHEMA.split(", ")[1:]]
    has = set(embeddings.columns)
    filled = embeddings.select("embedding_id", *(F.col(c) if c in has else F.lit("general" if c == "topic" else "").alias(c) for c in rest))
    single = filled.groupBy("embedding_id").agg(F.max_by(F.struct(*rest), F.struct("source_hash", F.xxhash64(*rest))).alias("r")).select("embedding_id", "r.*")
    dealt = single.repartition(shards, "embedding_id")
    dealt.write.format("sqlite_vectors").option("path", path).option("shards", shards).mode("overwrite" if overwrite else "append").save()


def read_vectors(spark: SparkSession, path: str, domain: str | None = None, topic: str | None = None, rows_per_task: int = RANGE) -> DataFrame:
    """A store's vectors; domain and topic are looked up by SQLite."""
    register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = spark.read.format("sqlite_vectors").option("path", path).option("rowsPerTask", rows_per_task).load()
    for name, value in (("domain", domain), ("topic", topic)):
        rows = rows.filter(F.col(name) == value) if value is not None else rows
    return rows
