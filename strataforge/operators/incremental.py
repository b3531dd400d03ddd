"""Change detection, upserts and write status: joins of a new state to the old one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def manifest(files: DataFrame) -> DataFrame:
    """rel_path and SHA-256 of the content (computed only if not there yet)."""
    return files.select("rel_path", F.col("sha256") if "sha256" in files.columns else F.sha2("content", 256).alias("sha256"))


def manifest_diff(old: DataFrame, new: DataFrame, key: str = "rel_path", digest: str = "sha256") -> DataFrame:
    """key and status: new, removed, modified or unchanged. One full outer join on the key; only digests are shuffled."""
    a, b = old.select(F.col(key).alias("old_key"), F.col(digest).alias("old_digest")), new.select(F.col(key).alias("new_key"), F.col(digest).alias("new_digest"))
    status = F.when(F.col("old_key").isNull(), "new").when(F.col("new_key").isNull(), "removed").when(F.col("old_digest").eqNullSafe(F.col("new_digest")), "unchanged").otherwise("modified")
    return a.join(b, F.col("old_key") == F.col("new_key"), "full").select(F.coalesce("new_key", "old_key").alias(key), status.alias("status"))


def change_summary(diff: DataFrame) -> DataFrame:
    """Counts by status, all files and whether anything changed, in one row."""
    n = lambda s: F.count_if(F.col("status") == s)
    changed = n("new") + n("removed") + n("modified")
    return diff.agg(F.count_if(F.col("status") != "removed").alias("total"), n("new").alias("new"), n("removed").alias("removed"), n("modified").alias("modified"), n("unchanged").alias("unchanged"), (changed > 0).alias("changed"))


#: Hex digits of a path's hash at each level of the checksum tree, from its leaves to its root.
LEVELS = (6, 4, 2, 0)


def directory_checksum(files: DataFrame, group: str | None = None, path: str = "rel_path", digest: str = "sha256", levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """One checksum over paths and digests: equal exactly if the sets of files are. A tree by the hash of the path: lines of the files
    whose hashes begin alike fold into a leaf, leaves into their parents, level by level, up to the root. A node has 256 children
    at most, and of ten thousand million files a leaf has about 600."""
    keys = [group] if group else []
    fold = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), "\n"), 256)
    name = F.col(path).cast("string")
    now = files.select(*keys, F.sha2(name, 256).alias("node"), F.concat(name, F.lit(":"), digest).alias("line"), F.lit(1).cast("long").alias("files"))
    for digits in levels:
        now = now.groupBy(*keys, F.substring("node", 1, digits).alias("node")).agg(fold("line").alias("checksum"), F.sum("files").alias("files"))
        now = now.select(*keys, "node", F.concat("node", F.lit(":"), "checksum").alias("line"), "files", "checksum")
    return now.select(*keys, "files", "checksum")


def set_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, and those that both have: key and side (old, both, new). One full outer join of distinct keys."""
    a, b = (df.select(F.col(key).alias(name)).distinct() for df, name in ((old, "a"), (new, "b")))
    both = a.join(b, F.col("a") == F.col("b"), "full")
    return both.select(F.coalesce("a", "b").alias(key), F.when(F.col("b").isNull(), "old").when(F.col("a").isNull(), "new").otherwise("both").alias("side"))


def exact_groups(rows: DataFrame, text: str, key: str) -> DataFrame:
    """Groups of equal texts by digest: hash, the least key and the number of copies; combined in the tasks."""
    return rows.groupBy(F.sha2(text, 256).alias("hash")).agg(F.min(key).alias(key), F.count("*").alias("copies"))


def write_status(old: DataFrame, new: DataFrame, key: str, digest: str, force: bool = True) -> DataFrame:
    """created, updated or skipped for each new row; without force rows that exist are skipped."""
    before = old.select(F.col(key).alias("old_key"), F.col(digest).alias("old_digest"))
    differs = ~F.col("old_digest").eqNullSafe(F.col(digest)) & F.lit(force)
    status = F.when(F.col("old_key").isNull(), "created").when(differs, "updated").otherwise("skipped")
    return new.join(before, F.col(key) == F.col("old_key"), "left").withColumn("status", status).drop("old_key", "old_digest")


def upsert_last(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Rows of both by key: new ones replace old ones, of several new ones the last by order counts. An aggregation, so each
    task keeps one row a key before the shuffle."""
    kept = [c for c in old.columns if c != key]
    both = old.withColumn("gen", F.lit(0)).unionByName(new.select(*old.columns).withColumn("gen", F.lit(1)))
    rank = F.struct("gen", order) if order else F.struct("gen", *kept)
    return both.groupBy(key).agg(F.max_by(F.struct(*kept), rank).alias("row")).select(key, "row.*").select(*old.columns)


def upsert_if_better(old: DataFrame, new: DataFrame, key: str, score: str) -> DataFrame:
    """New keys are inserted; known keys are updated only by a strictly greater score, and nulls never replace values."""
    cols = [c for c in old.columns if c != key]
    a = old.select(F.col(key).alias("old_key"), *(F.col(c).alias(f"old_{c}") for c in cols))
    b = new.select(F.col(key).alias("new_key"), *(F.col(c).alias(f"new_{c}") for c in cols))
    better = F.col("old_key").isNull() | (F.col(f"new_{score}") > F.coalesce(F.col(f"old_{score}"), F.lit(float("-inf"))))
    merged = [F.when(better, F.coalesce(f"new_{c}", f"old_{c}")).otherwise(F.col(f"old_{c}")).alias(c) for c in cols]
    return a.join(b, F.col("old_key") == F.col("new_key"), "full").select(F.coalesce("old_key", "new_key").alias(key), *merged)


def mark(rows: DataFrame, done: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Sets columns of rows whose key is in done; values may use done's columns."""
    hit = done.dropDuplicates([key]).withColumn("is_done", F.lit(True))
    pick = lambda c: F.when(F.col("is_done"), values[c]).otherwise(rows[c]).alias(c) if c in values else rows[c]
    return rows.join(hit, rows[key] == hit[key], "left").select(*(pick(c) for c in rows.columns))


def signature(input_checksum: str, output_checksum: str, config: str, version: str) -> dict[str, str]:
    """What a stage depends on; equal signatures mean that it can be skipped."""
    return {"input": input_checksum, "output": output_checksum, "config": config, "version": version}
