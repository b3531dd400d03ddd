import zlib

import numpy as np

from strataforge.llm import quality_model as Q


def crc(i, k):
    return zlib.crc32(str(i).encode()) % k


def test_gradients_of_fit_match_differences():
    rng = np.random.default_rng(0)
    m = {k: v.astype(np.float64) for k, v in Q._start(rng).items()}
    bags = [rng.random((n, Q.FEATURES)) for n in (1, 3, 2)]
    labels = np.array([1.0, 0.0, 1.0])
    x, starts = np.concatenate(bags), np.array([0, 1, 4])

    def loss(m):
        z = Q.attend(np.tanh(x @ m["W"]), starts, m)[3] @ m["c"] + m["b"]
        p = 1 / (1 + np.exp(-z))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    hidden = np.tanh(x @ m["W"])
    left, right, weight, bag, sizes = Q.attend(hidden, starts, m)
    assert np.allclose(np.add.reduceat(weight, starts), 1)
    off = (1 / (1 + np.exp(-(bag @ m["c"] + m["b"]))) - labels) / 3
    d_bag = np.repeat(off[:, None] * m["c"], sizes, 0)
    d_weight = (d_bag * hidden).sum(1)
    d_logit = weight * (d_weight - np.repeat(np.add.reduceat(weight * d_weight, starts), sizes))
    d_left = d_logit[:, None] * m["a"] * right * (1 - left**2)
    got = (hidden.T @ d_left)[3, 5]
    step = {**m, "V": m["V"].copy()}
    step["V"][3, 5] += 1e-5
    assert abs((loss(step) - loss(m)) / 1e-5 - got) < 1e-5


def test_held_out_accuracy_and_contract(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = Q.scored_documents(docs, labels).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    held = [r.predicted == quality[r.doc_id] for r in rows if r.held_out and r.doc_id in quality]
    assert len(held) > 50 and np.mean(held) > 0.95


def test_scores_do_not_depend_on_batches_or_blocks(monkeypatch):
    m = Q._start(np.random.default_rng(1))
    texts = [None, "", "a b c", "word " * 700, "Some THING!! | x | 12 " * 60]
    together = Q.score(texts, m)
    alone = np.concatenate([Q.score([t], m) for t in texts])
    monkeypatch.setattr(Q, "BLOCK", 2)
    assert np.allclose(together, alone, atol=1e-6) and np.allclose(Q.score(texts, m), together, atol=1e-6)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (2, "", 2), (None, "x " * 200000, 3)], "doc_id long, text string, Quality_Score int")
    none = spark.createDataFrame([(1, None, 0), (2, 1, 0), (2, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.score for r in Q.scored_documents(docs, none).collect()} == {0.5}
    assert Q.scored_documents(docs.limit(0), none).count() == 0
    ids = [i for i in range(100) if crc(i, 3) != 1][:2]
    one = spark.createDataFrame([(ids[0], 1, 0), (ids[1], 1, 0)], "doc_id long, quality int, toxic int")
    more = docs.unionByName(spark.createDataFrame([(ids[0], "t", 0), (ids[1], "u", 0)], docs.schema))
    assert {r.score for r in Q.scored_documents(more, one).collect()} == {1.0}
    kept = Q.keep_good(more, one)
    assert kept.columns == docs.columns and kept.count() == more.count()


def plain_score(text, m):
    """The probability passage by passage and feature by feature, without blocks or caches."""
    found = (text or "").encode("utf-8", "replace").split()
    passages = [found[i : i + Q.PASSAGE] for i in range(0, len(found), Q.PASSAGE)] or [[]]
    hidden = []
    for p in passages:
        x = np.zeros(Q.FEATURES)
        for w in p:
            x[Q.xxhash.xxh64_intdigest(w.lower(), 7) % Q.WORD_SLOTS] += 1 / len(p)
            x[Q.WORD_SLOTS + Q.xxhash.xxh64_intdigest(Q.shape(w.decode()).encode(), 11) % Q.SHAPE_SLOTS] += 1 / len(p)
        x = np.sqrt(x)
        n = [min(len(w.decode()), 255) for w in p]
        mean = lambda v: sum(v) / max(1, len(p))
        x[-8:] = mean([a == b for a, b in zip(p, p[1:])]), mean(n) / 10, mean([k * k for k in n]) ** 0.5 / 10, len(p) / Q.PASSAGE, not p, mean([k <= 2 for k in n]), mean([k >= 20 for k in n]), 1
        hidden.append(np.tanh(x @ m["W"]))
    attention = [float((np.tanh(h @ m["V"]) / (1 + np.exp(-(h @ m["U"])))) @ m["a"]) for h in hidden]
    weight = np.exp(np.array(attention) - max(attention))
    bag = sum(w * h for w, h in zip(weight / weight.sum(), hidden))
    return 1 / (1 + np.exp(-float(bag @ m["c"] + m["b"][0])))


def test_whole_table_against_brute_force(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), Q.labels_of(spark, sf)
    m = Q.learn(docs, labels)
    want = {r.doc_id: plain_score(r.text, m) for r in docs.collect()}
    got = {r.doc_id: r.score for r in Q.with_score(docs.select("doc_id", "text"), m).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-4 for i in want)


def test_labelled_texts_are_learnt_from_whole_and_repeats_once(spark, monkeypatch):
    ids = [i for i in range(400) if crc(i, 3) != 1]
    long = " ".join(f"w{k}" for k in range(20_000))
    rows = [(ids[0], long)] + [(ids[1], "same text")] * 500 + [(ids[1], "other text")] + [(i, f"text {i}") for i in ids[2:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2, 0) for k, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    got = Q.labelled_sample(docs, labels).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(set(rows)) and all(r.label == ids.index(r.doc_id) % 2 for r in got)
    bags = Q.labelled_sample(docs, labels).filter(f"doc_id = {ids[0]}").select("doc_id", "digest", "label", "text").mapInArrow(Q._features, "doc_id long, digest long, label int, bag binary").collect()
    assert len(bags[0].bag) // 2 == -(-20_000 // Q.PASSAGE) * Q.FEATURES
    few = Q.labelled_sample(docs, labels, 40, 30).collect()
    assert len(few) <= 40 and {r.label for r in few} == {0, 1}


def test_a_labelled_id_with_very_many_rows_is_bounded(spark):
    from pyspark.sql import functions as F

    ids = [i for i in range(100) if crc(i, 3) != 1][:2]
    docs = spark.range(200_000).select(F.lit(ids[0]).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")).unionByName(spark.createDataFrame([(ids[1], "one")], "doc_id long, text string"))
    labels = spark.createDataFrame([(ids[0], 1, 0), (ids[1], 0, 0)], "doc_id long, quality int, toxic int")
    assert Q.labelled_sample(docs, labels, 100).count() == 51
