"""Command line: bootstrap a workspace, run its stages, search it, see how far its files are; look into a store of papers."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strataforge.operators import literature, retrieval
from strataforge.plans import bootstrap
from strataforge.plans.runner import Blocked, Settings, Workspace, run, tracked
from strataforge.session import session


def main(args: list[str] | None = None) -> int:
    """Exit codes: 0 done, 1 blocked by a check, 2 wrong use, 3 nothing changed."""
    p = argparse.ArgumentParser("strataforge")
    p.add_argument("--master", help="Spark master; from spark-submit if not given")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("bootstrap")
    r = sub.add_parser("run")
    s = sub.add_parser("search")
    for x in (b, r, s):
        x.add_argument("workspace")
        x.add_argument("--domain", required=True)
    b.add_argument("--seeds", action="store_true")
    b.add_argument("--force", action="store_true")
    r.add_argument("raw")
    r.add_argument("--topic", default="general")
    r.add_argument("--formats")
    r.add_argument("--full", action="store_true")
    r.add_argument("--dry-run", action="store_true")
    r.add_argument("--fail-on-warning", action="store_true")
    s.add_argument("query")
    s.add_argument("-k", type=int, default=5)
    s.add_argument("--topic")
    t = sub.add_parser("files")
    t.add_argument("workspace")
    t.add_argument("raw")
    t.add_argument("--formats")
    i = sub.add_parser("papers")
    i.add_argument("store", help="a folder of Parquet")
    i.add_argument("--topic")
    i.add_argument("--top", type=int, default=5)
    i.add_argument("--least", type=float, default=0.0)
    i.add_argument("--export", metavar="FOLDER")
    i.add_argument("--form", choices=("csv", "json"), default="csv")
    i.add_argument("--force", action="store_true")
    a = p.parse_args(args)
    spark = session(master=a.master)
    if a.command == "bootstrap":
        for path, what in bootstrap.create(spark, a.workspace, a.domain, a.seeds, a.force):
            print(what, path)
        return 0
    if a.command == "files":
        flags = ("in_documents", "in_chapters", "in_chunks")
        found = tracked(spark, a.raw, a.workspace, a.formats).agg(F.count("*").alias("files"), *(F.count_if(f).alias(f) for f in flags))
        print(json.dumps(found.first().asDict()))
        return 0
    if a.command == "papers":
        store = spark.read.parquet(a.store)
        print(json.dumps(literature.totals(store).first().asDict()))
        for row in literature.source_stats(store).orderBy("source").collect():
            print(json.dumps(row.asDict(), ensure_ascii=False))
        chosen = literature.best(store, a.top, a.topic, a.least)
        for row in literature.listing(chosen).orderBy(F.desc("relevance_score"), "paper_id").collect():
            print(row.line)
        if a.export:
            try:
                literature.export(chosen, a.export, a.form, a.force)
            except AnalysisException as e:
                print(e, file=sys.stderr)
                return 1
        return 0
    if a.command == "search":
        work = Workspace(spark, a.workspace)
        state = work.state()
        found = retrieval.search(work.read("embeddings", state), work.read("evidence", state), a.query, a.k, a.domain, a.topic)
        for row in found.orderBy("score", ascending=False).collect():
            print(json.dumps(row.asDict(), ensure_ascii=False))
        return 0
    try:
        report = run(spark, a.raw, a.workspace, Settings(a.domain, a.topic, a.formats, fail_on_warning=a.fail_on_warning), full=a.full, dry_run=a.dry_run)
    except Blocked as e:
        print(e, file=sys.stderr)
        return 1
    print(json.dumps(report, default=str))
    return 3 if report["status"] == "no_changes" else 0


if __name__ == "__main__":
    sys.exit(main())
