"""Upserts on streams: a row replaces what is known of its key only if its score is better, and nulls never replace values."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strataforge.operators.rounds import shared_folder

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Better(StatefulProcessor):
    """The best row of each key so far. Rows come in the order of `order` within a batch. With idle_ms a key that had no better row for
    so long is forgotten, by a timer."""

    def __init__(self, kept: T.StructType, key: str, score: str, order: list[str], idle_ms: int | None):
        self.kept, self.key, self.score, self.order, self.idle = kept, key, score, order, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.kept)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        names = self.kept.names
        arrived = pd.concat([f.astype(object) for f in rows], ignore_index=True).sort_values(self.order, kind="stable")
        at = names.index(self.score)
        now = list(self.best.get()) if self.best.exists() else None
        changed = False
        for new in arrived[names].itertuples(index=False):
            values = [None if pd.isna(v) else v for v in new]
            if now is None:
                now, changed = values, True
            elif values[at] is not None and (now[at] is None or values[at] > now[at]):
                now, changed = [o if v is None else v for v, o in zip(values, now, strict=True)], True
        if changed:
            self.best.update(tuple(now))
            if self.idle is not None:
                for old in list(self.handle.listTimers()):
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.idle)
            yield pd.DataFrame([[key[0], *now]], columns=[self.key, *names]).astype(object)

    def handleExpiredTimer(self, key, timers, expired) -> Iterator[pd.DataFrame]:
        self.best.clear()
        yield pd.DataFrame()

    def close(self) -> None:
        """Nothing is open."""


def upsert_stream(rows: DataFrame, key: str, score: str, order: list[str], idle_ms: int | None = None) -> DataFrame:
    """A stream of what is known of a key, given whenever it gets better. The session's state store must be STATE_STORE."""
    kept = T.StructType([f for f in rows.schema if f.name != key])
    out = T.StructType([rows.schema[key], *kept])
    return rows.groupBy(key).transformWithStateInPandas(Better(kept, key, score, order, idle_ms), outputStructType=out, outputMode="Update", timeMode="ProcessingTime" if idle_ms is not None else "None")


def streamed_upsert(rows: DataFrame, key: str, score: str, order: list[str], idle_ms: int | None = None) -> DataFrame:
    """Runs a stream until all is read; the last state of every key."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    out = f"{shared_folder(spark.range(0))}/upsert-{uuid.uuid4().hex}"

    def store(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/rows/n={number}")

    made = upsert_stream(rows, key, score, order, idle_ms)
    run = made.writeStream.outputMode("update").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).foreachBatch(store).start()
    run.awaitTermination()
    rest = [c for c in made.columns if c != key]
    return spark.read.schema(T.StructType([*made.schema, T.StructField("batch", T.IntegerType())])).parquet(f"{out}/rows/*").groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(key, "r.*")
