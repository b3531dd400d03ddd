"""Runs the stage graph over a workspace of Parquet layers, in full or only for the documents that changed, with checks between layers.

A layer is dealt into buckets by a hash of its document's id. A full run writes all buckets. An incremental run finds the documents
whose file, name or time changed, runs every stage on the rows of those alone, and writes new versions of the buckets that they
fall into: rows of other documents are copied, rows of changed and removed ones are not. Nothing that a state names is ever
written over, and the state is replaced by a rename, so readers see a layer before or after a run and nothing between.

Files are read once for their digests; only changed ones are read again to be converted.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.operators import incremental, stages, textplan, validate
from strataforge.plans.registry import STAGES, affected, order
from strataforge.sources import convert, files

VERSION = "3"
#: stage -> layers that it writes; all but the last are by-products.
WRITES: dict[str, tuple[str, ...]] = {
    "discover_sources": ("raw",),
    "ingest": ("converted", "ingest_errors", "documents"),
    "chapter_splitter": ("chapters",),
    "chunk_builder": ("chunks",),
    "evidence_index": ("evidence",),
    "embedding_builder": ("embeddings",),
    "wiki_builder": ("wiki",),
    "analysis_builder": ("topic_counts", "analysis"),
}
#: stage -> transition that is checked after it
CHECKS = {"chapter_splitter": ("10_to_20", "documents", "chapters"), "chunk_builder": ("20_to_30", "chapters", "chunks"), "evidence_index": ("30_to_40", "chunks", "evidence"), "embedding_builder": ("40_to_50", "evidence", "embeddings")}
#: Documents a bucket should hold, and the most buckets of a workspace.
PER_BUCKET, MOST_BUCKETS = 5_000, 4_096
#: Changed files that are opened by name; of more, the folder is scanned again.
BY_NAME = 10_000
RUNS = "run="


@dataclass
class Settings:
    domain: str
    topic: str = "general"
    formats: str | None = None
    min_words: int = 1
    rules: textplan.Rules = field(default_factory=textplan.Rules)
    fail_on_warning: bool = False
    stop_on_error: bool = True
    least_tokens: int = validate.MIN_TOKENS
    most_tokens: int = validate.MAX_TOKENS

    def __post_init__(self):
        if not (self.domain.isidentifier() and self.domain == self.domain.lower() and self.domain[0].isalpha() and self.domain.isascii()):
            raise ValueError(f"not a domain name: {self.domain!r}")

    def digest(self) -> str:
        return hashlib.sha256(json.dumps(self.__dict__, sort_keys=True, default=repr).encode()).hexdigest()[:16]


class Blocked(RuntimeError):
    """A check between layers found what must not be passed on."""


class Workspace:
    """Layers under one folder; the state names the run that wrote each bucket of each layer."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def state(self) -> dict:
        path = self._path("state.json")
        if not self._fs(path).exists(path):
            return {}
        return json.loads("\n".join(r.value for r in self.spark.read.text(str(path)).collect()))

    def save(self, state: dict) -> None:
        """Written beside the old state, then renamed onto it."""
        new, path = self._path(f"state-{uuid.uuid4().hex}.json"), self._path("state.json")
        fs = self._fs(path)
        fs.setWriteChecksum(False)
        out = fs.create(new, True)
        out.write(bytearray(json.dumps(state, indent=1, sort_keys=True).encode()))
        out.close()
        jvm = self.spark._jvm
        how = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(new, path, how)

    def read(self, layer: str, state: dict, buckets: list[int] | None = None) -> DataFrame:
        """A layer, or some of its buckets."""
        known = state["layers"][layer]
        schema = T.StructType.fromJson(json.loads(known["schema"]))
        paths = [f"{self.folder}/{layer}/{RUNS}{run}/bucket={b}" for b, run in known["buckets"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def write(self, layer: str, rows: DataFrame, run: str, state: dict, bucket: Column | None = None, only: list[int] | None = None) -> None:
        """A layer's rows by bucket (one, if none is given); with only, those buckets are replaced and the others stay as they are."""
        rows.withColumn("bucket", F.lit(0) if bucket is None else bucket).write.partitionBy("bucket").parquet(f"{self.folder}/{layer}/{RUNS}{run}")
        path = self._path(f"{layer}/{RUNS}{run}")
        names = [s.getPath().getName() for s in self._fs(path).listStatus(path)]
        written = {n.removeprefix("bucket="): run for n in names if n.startswith("bucket=")}
        layers = state.setdefault("layers", {})
        before = layers.get(layer, {}).get("buckets", {}) if only is not None else {}
        layers[layer] = {"schema": rows.schema.json(), "buckets": {b: r for b, r in before.items() if int(b) not in only} | written}

    def clean(self) -> list[str]:
        """Deletes the versions that neither the present state nor the one before names; gives their folders."""
        state = self.state()
        wanted = {(layer, run) for s in (state, state.get("before", {})) for layer, known in s.get("layers", {}).items() for run in known["buckets"].values()}
        gone = []
        for layer in state.get("layers", {}):
            top = self._path(layer)
            for status in self._fs(top).listStatus(top) if self._fs(top).exists(top) else []:
                name = status.getPath().getName()
                if name.startswith(RUNS) and (layer, name.removeprefix(RUNS)) not in wanted:
                    self._fs(top).delete(status.getPath(), True)
                    gone.append(f"{layer}/{name}")
        return sorted(gone)


def bucket_of(state: dict) -> Column:
    return F.pmod(F.xxhash64("document_id"), F.lit(state["buckets"])).cast("int")


class Layers:
    """What stages read and write in one run: all rows, or those of the changed documents merged into what is there."""

    def __init__(self, work: Workspace, state: dict, run: str, changed: DataFrame | None, buckets: list[int] | None):
        self.work, self.state, self.run, self.changed, self.buckets = work, state, run, changed, buckets
        self.fresh: dict[str, DataFrame] = {}

    def read(self, layer: str) -> DataFrame:
        """The rows that a stage works on."""
        if self.changed is None:
            return self.work.read(layer, self.state)
        if layer not in self.fresh:  # a stage that was left out: the changed documents' rows of its layer
            self.fresh[layer] = self.work.read(layer, self.state, self.buckets).join(self.changed, "document_id", "left_semi")
        return self.fresh[layer]

    def write(self, layer: str, rows: DataFrame) -> None:
        if self.changed is None:
            self.work.write(layer, rows, self.run, self.state, bucket_of(self.state))
            return
        made = f"{self.work.folder}/made/{RUNS}{self.run}/{layer}"
        rows.write.parquet(made)
        self.fresh[layer] = fresh = self.work.spark.read.schema(rows.schema).parquet(made)
        others = self.work.read(layer, self.state, self.buckets).join(self.changed, "document_id", "left_anti")
        self.work.write(layer, others.unionByName(fresh), self.run, self.state, bucket_of(self.state), self.buckets)


def converted(layers: Layers, raw: str, settings: Settings) -> DataFrame:
    """Files' texts. A few changed files are opened by name, many found by scanning the folder."""
    spark, known = layers.work.spark, layers.read("raw").select("path", "document_id", "rel_path", "ext", "mtime", "sha256")
    paths = [r.path for r in known.select("path").limit(BY_NAME + 1).collect()] if layers.changed is not None else None
    if paths is None or len(paths) > BY_NAME:
        contents = files.discover(spark, raw, settings.formats, digests=False).select("path", "content")
    elif paths:
        plain = [re.sub(r"([{}\[\]*?\\])", r"\\\1", p) for p in paths]
        contents = spark.read.format("binaryFile").load(plain).select("path", "content")
    else:
        contents = spark.createDataFrame([], "path string, content binary")
    return convert.to_markdown(contents.join(known, "path").drop("path"))


def build(stage: str, layers: Layers, raw: str, settings: Settings) -> DataFrame:
    get = layers.read
    if stage == "ingest":
        return stages.normalise_documents(get("converted").filter("error is null").drop("error"), settings.domain, settings.topic)
    if stage == "chapter_splitter":
        return stages.split_chapters(get("documents"), min_words=settings.min_words)
    if stage == "chunk_builder":
        return stages.plan_chunks(get("chapters"), settings.rules)
    if stage == "evidence_index":
        return stages.build_evidence(get("chunks"))
    if stage == "embedding_builder":
        return stages.build_embeddings(get("evidence"), kept=("document_id",))
    return stages.wiki_sections(get("evidence"), kept=("document_id",))  # rows, as no row should hold a whole topic; wiki_pages joins them


def counted(layers: Layers) -> None:
    """Entries by topic: of each bucket that has changed, then of the workspace."""
    work, state = layers.work, layers.state
    parts = work.read("wiki", state, layers.buckets).groupBy(bucket_of(state).alias("part"), "topic").agg(F.count("*").alias("entries"))
    work.write("topic_counts", parts, layers.run, state, F.col("part"), layers.buckets)
    total = work.read("topic_counts", state).agg(F.count_distinct("topic").alias("topics"), F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"))
    work.write("analysis", total, layers.run, state)


def tracked(spark: SparkSession, raw: str, folder: str, formats: str | None = None) -> DataFrame:
    """How far each raw file has come: rel_path, length, mtime and whether the workspace has its document, chapters and chunks."""
    work = Workspace(spark, folder)
    state = work.state()
    found = files.discover(spark, raw, formats, content=False).drop("path")
    if "documents" not in state.get("layers", {}):
        return found.withColumns({f"in_{x}": F.lit(False) for x in ("documents", "chapters", "chunks")})
    docs = work.read("documents", state).select(F.col("lineage").alias("rel_path"), "document_id")
    have = {"documents": docs}
    for layer in ("chapters", "chunks"):
        rows = work.read(layer, state).select("document_id").distinct() if layer in state["layers"] else docs.select("document_id").limit(0)
        have[layer] = docs.join(rows, "document_id", "left_semi")
    return files.layer_listing(found, have, "rel_path")


def manifest_of(work: Workspace, raw: str, settings: Settings, run: str) -> DataFrame:
    """Paths, digests, times and document ids of all files, written once; no later step reads the bytes for them again."""
    named = stages.document_names(files.discover(work.spark, raw, settings.formats).drop("content")).drop("source_slug", "doc_stem")
    path = f"{work.folder}/manifests/{RUNS}{run}"
    named.write.parquet(path)
    return work.spark.read.schema(named.schema).parquet(path)


def changed_documents(old: DataFrame, new: DataFrame) -> DataFrame:
    """document_id and status of documents that are new or removed, or whose file, its time or its path differ."""
    digest = F.sha2(F.concat_ws("\0", "rel_path", "sha256", "mtime", "ext"), 256)
    diff = incremental.manifest_diff(old.withColumn("digest", digest), new.withColumn("digest", digest), "document_id", "digest")
    return diff.filter("status <> 'unchanged'")


def run(spark: SparkSession, raw: str, folder: str, settings: Settings, full: bool = False, dry_run: bool = False, only: tuple[str, ...] | None = None, report: Callable[[dict], None] | None = None) -> dict:
    """Runs all stages on all documents the first time, with full, or when settings or version changed; else all stages on the
    documents that changed. Stages that `only` leaves out are made up for, in full, by the next run without it. Returns a
    report; raises Blocked where a check stops the run. A dry run says what would run and writes no layer."""
    work, wanted = Workspace(spark, folder), settings.digest()
    before = work.state()
    state = {} if full else json.loads(json.dumps(before))
    run_id = uuid.uuid4().hex[:16]
    manifest = manifest_of(work, raw, settings, run_id)
    out: dict = {"ran": [], "skipped": [], "rows": {}, "messages": {}, "status": "ok", "run": run_id, "mode": "full"}
    whole = set(STAGES)
    changed, buckets = None, None
    try:
        if state and state.get("settings") == wanted and state.get("version") == VERSION:
            old = work.read("raw", state)
            summary = incremental.change_summary(incremental.manifest_diff(old.select("rel_path", "sha256"), manifest.select("rel_path", "sha256"))).first()
            out["changes"] = summary.asDict()
            whole = affected(STAGES, set(state.get("behind", []))) | {s for s in STAGES if any(x not in state["layers"] for x in WRITES[s])}
            if not whole and not summary.changed:
                return out | {"status": "no_changes", "skipped": order(STAGES), "mode": "none"}
            diff = changed_documents(old, manifest)
            path = f"{work.folder}/changes/{RUNS}{run_id}"
            diff.withColumn("bucket", bucket_of(state)).write.parquet(path)
            diff = spark.read.schema("document_id string, status string, bucket int").parquet(path)
            changed, buckets = diff.select("document_id"), sorted(r.bucket for r in diff.select("bucket").distinct().collect())
            out |= {"mode": "changed", "documents_changed": diff.count(), "buckets": len(buckets)}
        else:
            state = {"buckets": min(MOST_BUCKETS, max(1, manifest.count() // PER_BUCKET))}
        layers = Layers(work, state, run_id, changed, buckets)
        for stage in order(STAGES):
            if only and stage not in only:
                out["skipped"].append(stage)
                continue
            out["ran"].append(stage)
            if dry_run:
                continue
            # a stage that is behind is made for all documents; its upstream layers are whole by now
            at = layers if stage not in whole else Layers(work, state, run_id, None, None)
            _stage(stage, at, raw, manifest, settings, out)
            layers.fresh.update(at.fresh)
        if dry_run:
            return out
        left = [s for s in out["skipped"] if s in whole or changed is not None]
        kept = {k: before[k] for k in ("layers", "run") if k in before}
        work.save(state | {"settings": wanted, "version": VERSION, "run": run_id, "behind": left, "before": kept})
    finally:
        _forget(work, [f"manifests/{RUNS}{run_id}", f"changes/{RUNS}{run_id}", f"made/{RUNS}{run_id}"])
    if report:
        report(out)
    return out


def _forget(work: Workspace, names: list[str]) -> None:
    for name in names:
        path = work._path(name)
        work._fs(path).delete(path, True)


def _stage(stage: str, layers: Layers, raw: str, manifest: DataFrame, settings: Settings, out: dict) -> None:
    work, state = layers.work, layers.state
    if stage == "discover_sources":
        rows = manifest if layers.changed is None else manifest.join(layers.changed, "document_id", "left_semi")
        layers.write("raw", rows)
    elif stage == "analysis_builder":
        counted(layers)
    else:
        if stage == "ingest":  # files are converted once; what could not be is kept with its error and counted
            layers.write("converted", converted(layers, raw, settings))
            layers.write("ingest_errors", layers.read("converted").filter("error is not null").select("document_id", "rel_path", "error"))
            out["rows"]["ingest_errors"] = work.read("ingest_errors", state).count()
        layers.write(WRITES[stage][-1], build(stage, layers, raw, settings))
    out["rows"][WRITES[stage][-1]] = work.read(WRITES[stage][-1], state).count()
    if layers.changed is not None and WRITES[stage][-1] in layers.fresh:
        out.setdefault("fresh", {})[WRITES[stage][-1]] = layers.fresh[WRITES[stage][-1]].count()
    if stage in CHECKS:
        transition, before, after = CHECKS[stage]
        messages = validate.validate(transition, layers.read(before), layers.read(after), settings.least_tokens, settings.most_tokens)
        work.write(f"messages_{transition}", messages, layers.run, state)
        messages = work.read(f"messages_{transition}", state)
        out["messages"][transition] = {r.severity: r["count"] for r in messages.groupBy("severity").count().collect()}
        if validate.blocks(messages, settings.fail_on_warning, settings.stop_on_error):
            raise Blocked(f"{transition}: {out['messages'][transition]}")
