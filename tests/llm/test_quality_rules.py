import random
import re

from llm_oracle import same

from strataforge.llm import quality_rules as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    repeated = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_counts(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t", "a", "a b c d e f g h", "é ü 😀😀 #<|", "x\n\nx\n x\nx", "a " * 50, "b " * 30000]
    texts += ["".join(rng.choice("ab \n#") for _ in range(rng.randrange(200))) for _ in range(60)]
    base = " ".join(f"w{i}" for i in range(30))
    texts += [base + " mid " + base, base + " " + base[:40], " ".join(rng.choice("ab") for _ in range(40))]
    docs = spark.createDataFrame([(i, t, "h", 0) for i, t in enumerate(texts)], "doc_id long, text string, source string, n_words int")
    got = {r.doc_id: r for r in Q.document_verdicts(docs).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        assert tuple(got[i][c] for c in Q.COUNTS) == want, t
        assert got[i].base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])


GOOD = " ".join(f"word{i}" for i in range(40))
BAD = " ".join(f"#w{i}" for i in range(40))


def test_bad_hosts_go_and_small_ones_are_shrunk(spark):
    rows = [(i, GOOD, "fine") for i in range(60)] + [(100 + i, BAD, "spam") for i in range(200)] + [(400, GOOD, "spam"), (401, BAD, "one"), (402, GOOD, None), (403, None, None), (402, GOOD, None)]
    rows += [(500 + i, GOOD, f"host{i % 9}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in Q.document_verdicts(docs).collect()}
    assert kept[0] and not kept[100] and not kept[400] and kept[402] and not kept[403]
    assert kept[401], "one failing document says little about its host"
    stay = Q.keep_by_rules(docs.withColumn("kept", docs.doc_id))
    assert stay.columns == ["doc_id", "text", "source", "kept"]
    assert stay.count() == sum(kept[r[0]] for r in rows)
    assert Q.document_verdicts(docs.limit(0)).count() == 0


def test_sql(spark, sf):
    same(Q.document_verdicts(spark.read.parquet(f"{sf}/documents.parquet")), Q.document_verdicts_sql(), sf)


def test_a_host_whose_documents_fail_different_rules(spark, tmp_path):
    """No rule fails more than half of the host's documents, but hardly a document passes; the SQL rejects it too."""
    lines = "same\n" * 6 + " ".join(f"z{i}" for i in range(30))
    rows = [(i, GOOD, f"h{i % 12}") for i in range(240)] + [(1000 + i, (BAD, lines, GOOD)[min(i % 9, 8) // 4], "mixed") for i in range(180)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in Q.document_verdicts(docs).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == {i for i, _, h in rows if h == "mixed"}
    import pyarrow as pa
    import pyarrow.parquet as pq

    for t in ("documents", "pages", "benchmark", "labels"):
        pq.write_table(pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "source": [r[2] for r in rows]}), tmp_path / f"{t}.parquet")
    same(Q.document_verdicts(docs), Q.document_verdicts_sql(), tmp_path)
    assert {r.doc_id for r in Q.keep_by_rules(docs).collect()} == {i for i, r in got.items() if r.kept}
