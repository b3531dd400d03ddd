from collections import Counter

import numpy as np
from test_decontaminate import brute as brute_items
from test_nearcopies import brute as brute_near
from test_packing import check, piece_by_piece
from test_quality_rules import brute as brute_counts

import corpus_pipeline as C
from strataforge.llm import packing, quality_model, quality_rules


def test_every_stage_against_brute_force_and_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in C.STAGES]
    assert len(names) == 5 and C.ORACLE_SQL is None
    kept, rows = [], docs.collect()
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        kept.append({r.doc_id: r for r in docs.collect()})

    model = quality_model.learn(spark.read.parquet(f"{sf}/documents.parquet"), quality_model.labels_of(spark, sf))
    good = [r for r, s in zip(rows, quality_model.score([r.text for r in rows], model), strict=True) if s >= 0.5]
    assert kept[0] == {r.doc_id: r for r in good} and len(good) < len(rows)

    def passes(r):
        words, _, _, _, repeated = brute_counts(r.text)
        return words >= 20 and 100 * repeated <= 30 * words

    counted = quality_rules.document_verdicts(spark.createDataFrame(good)).collect()
    assert all(r.kept == (not r.base_failed) for r in counted), "no host is bad here"
    fine = [r for r in good if passes(r)]
    assert kept[1] == {r.doc_id: r for r in fine} and len(fine) < len(good)

    stay = brute_near([(r.doc_id, r.text) for r in fine])  # all pairs with five-word Jaccard of 0.8 or more
    first = [r for r in fine if r.doc_id in stay]
    assert kept[2] == {r.doc_id: r for r in first} and len(first) < len(fine)

    leaked = {d for d, _ in brute_items([(r.doc_id, r.text) for r in first], [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])}
    clean = [r for r in first if r.doc_id not in leaked]
    assert kept[3] == {r.doc_id: r for r in clean} and leaked

    packed = C.run(spark, sf).collect()
    bins = check(packed, [(r.doc_id, r.text) for r in clean], packing.SIZES)
    assert Counter((c[0][2], tuple(sorted(x[1] for x in c))) for c in bins.values()) == piece_by_piece([r.n_tokens for r in packed], packing.SIZES, packing.cost)
    text = {}
    for r in sorted(packed, key=lambda r: (r.doc_id, r.piece)):
        text[r.doc_id] = text.get(r.doc_id, "") + r.text
    assert text == {r.doc_id: r.text for r in clean}
    assert np.sum([r.n_tokens for r in packed]) > 0


def test_edge_cases_flow_through(spark, sf):
    long = " ".join(f"plain word{i}" for i in range(3000))
    rows = [(1, None, "en", None, 0, 1), (2, "", None, "s", 0, 1), (3, long, "en", "s", 1, 1), (3, long, "en", "s", 1, 1), (None, long + " end", "en", "s", 1, 1), (None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, KEPT int")
    for frame in (docs, docs.limit(0)):
        for _, stage in C.STAGES:
            frame = stage(spark, frame, sf)
            frame = spark.createDataFrame(frame.collect(), frame.schema)
        assert {r.doc_id for r in frame.collect()} <= {3, None}
