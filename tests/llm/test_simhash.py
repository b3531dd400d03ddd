import numpy as np
import xxhash

from strataforge.llm import simhash as S


def brute_fp(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w)] if 0 < len(w) < 3 else [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def brute_components(ids, fps):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(fps))]


def test_whole_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    want = {(r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components([r.doc_id for r in rows], fps), strict=True)}
    got = {tuple(r) for r in S.simhash_components(docs).collect()}
    assert got == want


def clouds(seed, centres, members, bits):
    rng = np.random.default_rng(seed)
    out = set()
    for c in rng.integers(0, 2**63, centres):
        for _ in range(members):
            x = int(c)
            for b in rng.choice(64, rng.integers(0, bits + 1), replace=False):
                x ^= 1 << int(b)
            out.add(x)
    return sorted(out)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_links_connect_what_brute_force_connects(spark):
    for fps, block in ((clouds(1, 40, 12, 4), S.BLOCK), (clouds(2, 2, 300, 3), S.BLOCK), (clouds(3, 2, 300, 3), 16)):
        nodes = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
        got = {r.node % 2**64: r.root for r in S.connected_components(S.fingerprint_links(nodes, block)).collect()}
        want = brute_components([signed(x) for x in fps], fps)
        assert [got.get(x, signed(x)) for x in fps] == want


def test_long_runs_are_streamed():
    fps = np.array(clouds(4, 1, 400, 3), np.uint64)
    import pyarrow as pa

    n = len(fps)
    stored = fps[:50]
    cols = [np.zeros(n, np.int64), np.zeros(n, np.int32), np.r_[np.zeros(50, np.int8), np.ones(n - 50, np.int8)], np.r_[stored, fps[50:]].view(np.int64)]
    batches = [pa.record_batch([pa.array(c[k : k + 64]) for c in cols], ["cell", "block", "role", "fp"]) for k in range(0, n, 64)]
    old, S.BLOCK = S.BLOCK, 20
    try:
        links = [(u, v) for b in S._links(iter(batches)) for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    finally:
        S.BLOCK = old
    class_of = dict(zip(fps.tolist(), brute_components([signed(x) for x in fps.tolist()], fps.tolist()), strict=True))
    assert all(class_of[u % 2**64] == class_of[v % 2**64] for u, v in links)
    joined = {x % 2**64 for pair in links for x in pair}
    for i, x in enumerate(fps.tolist()):
        near = any(y != x and (x ^ y).bit_count() <= 3 for y in stored.tolist())
        if i >= 50:
            assert near == (x in joined)


EDGE = [(1, None, "a"), (2, "", "b"), (3, " \n ", "c"), (3, "x", "d"), (None, "x", "e"), (5, "One two", "f"), (6, "one TWO", "g"), (7, "w " * 90000, None), (7, "w " * 90000, None), (None, "lonely text here now", None)]


def test_edge_cases(spark):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, FP string")
    got = S.simhash_components(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = got.collect()
    fps = [brute_fp(t) for _, t, _ in EDGE[:7]]
    assert len(rows) == len(EDGE)
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert {(r.fingerprint) for r in rows} >= {f"{f:016x}" for f in fps}
    assert S.simhash_components(docs.limit(0)).count() == 0


def test_one_row_per_class_stays(spark):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, FP string")
    kept = S.keep_one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 3), (False, 5), (False, 7), (True, 0)]
