import random

import numpy as np

import corpus_pipeline as C
from strataforge.llm import nearcopies as N

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows):
    """doc_ids that stay: least ids of the components of all pairs with five-word Jaccard of 0.8 or more."""
    def grams(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    found, root = [grams(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(found[i] & found[j])
            if both >= 0.8 * (len(found[i]) + len(found[j]) - both):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return {min(rows[j][0] for j in range(len(rows)) if top(j) == top(i)) for i in range(len(rows))}


def edited(words, n, rng):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def test_stage_equals_exact_jaccard(spark, sf):
    rng = random.Random(4)
    rows = []
    for base in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 300))]
        for copy in range(4):
            rows.append((len(rows), edited(words, min(copy, len(words) // 70), rng)))
    words = [f"g{rng.randrange(3000)}" for _ in range(150)]
    rows += [(len(rows) + i, edited(words, i % 7, rng)) for i in range(60)]  # a group larger than NEXT
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    kept = {r.doc_id for r in dict(C.STAGES)["simhash_near_dedup"](spark, docs, sf).collect()}
    want = brute(rows)
    assert kept == want and len(want) < len(rows) - 60


def test_crowded_cells_are_cut_and_lose_no_link(spark, monkeypatch):
    """One group of near copies around 0.8, where links and near misses mix: pieces and blocks far smaller than its cells."""
    rng = random.Random(9)
    words = [f"g{rng.randrange(3000)}" for _ in range(140)]
    rows = [(i, edited(words, rng.randrange(1, 8), rng)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert 20 < len(want) < 290
    for piece, outside in ((8192, 512), (16, 4)):
        monkeypatch.setattr(N, "PIECE", piece)
        monkeypatch.setattr(N, "OUTSIDE", outside)
        assert {r.doc_id for r in N.keep_one_per_class(docs).collect()} == want


def test_ids_that_repeat_do_not_join_texts(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (1, "alpha beta gamma delta epsilon zeta"), (None, None), (2, " ")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in N.keep_one_per_class(docs).collect()) == [(1, "alpha beta gamma delta epsilon zeta"), (1, "one two three four five six"), (2, " ")]
    assert N.keep_one_per_class(docs.limit(0)).count() == 0


def test_fingerprints_are_simhash_and_their_cells_are_grids_of_the_embedding():
    rng = np.random.default_rng(5)
    for size in (1, 2, 7, 300, 700):
        found = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        words = np.stack([N.fingerprint(found[k : k + 1], N.LONG) for k in range(size)])  # of one shingle: the bits that it votes for
        bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little").astype(int)
        want = 2 * bits.sum(0) > size
        assert N.fingerprint(found, N.LONG).tobytes() == np.packbits(want, bitorder="little").tobytes()
        assert (N.fingerprint(found) == N.fingerprint(found, N.LONG)[: N.WORDS]).all()

    fps = rng.integers(0, 1 << 63, (50, N.WORDS)).astype(np.uint64)
    axes = np.unpackbits(fps.view(np.uint8), axis=1, bitorder="little").reshape(50, N.WORDS, 32, 2).sum(-1)  # bit counts of the segments
    cells = N.cells_of(fps)
    assert cells.shape == (50, N.GRIDS) and len({*cells[0].tolist()}) == N.GRIDS
    for grid in range(N.GRIDS):
        own = axes[:, grid // 5, grid % 5 * N.AXES :][:, : N.AXES]
        assert ((cells[:, None, grid] == cells[None, :, grid]) == (own[:, None] == own[None]).all(-1)).all()

    a, b = rng.integers(0, 1 << 63, (2, 60, N.FIRST)).astype(np.uint64)
    b[:30] = a[:30] ^ (np.uint64(1) << rng.integers(0, 64, (30, N.FIRST)).astype(np.uint64))
    exact = np.bitwise_count(a[:, None] ^ b[None]).sum(-1) <= N.FIRST_BITS
    assert {*zip(*(x.tolist() for x in N._close(a, b)), strict=True)} == {*zip(*(x.tolist() for x in np.nonzero(exact)), strict=True)}


def test_pairs_at_the_threshold_meet():
    """500 pairs at Jaccard 0.8 exactly, of sets of 16 to 250 shingles: all share a cell and pass both distances."""
    rng = np.random.default_rng(6)
    for k in range(500):
        unit = rng.integers(4, 50)
        found = rng.integers(0, 1 << 63, 5 * unit).astype(np.uint64)
        one, other = (found[: 4 * unit], found) if k % 2 else (found[: 9 * (unit // 2)], found[unit // 2 : 10 * (unit // 2)])
        assert N.jaccard(np.sort(one), np.sort(other)) == 0.8
        fps = np.stack([np.r_[N.fingerprint(np.sort(x), N.LONG), np.uint64(len(x))] for x in (one, other)])
        assert len(N._close(fps[:1], fps[1:])[0]) == 1 and N._alike(fps[:1], fps[1:]).all()
        assert (N.cells_of(fps[:1]) == N.cells_of(fps[1:])).any()


def test_rows_meet_by_simhash_only_and_crowded_cells_are_cut(spark, monkeypatch):
    rng = random.Random(12)
    words = [f"g{rng.randrange(3000)}" for _ in range(140)]
    rows = [(i, edited(words, rng.randrange(1, 8), rng)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    assert 5 < len(want) < 115
    monkeypatch.setattr(N, "CROWDED", 10)
    assert {r.doc_id for r in N.keep_one_per_class(docs).collect()} == want
    monkeypatch.setattr(N, "FIRST_BITS", -1)
    assert N.keep_one_per_class(docs).count() == len({t for _, t in rows})


def test_stage_keeps_what_exact_jaccard_keeps_on_the_whole_table(spark):
    """All pairs of sf0.01's different texts, those of unlike lengths left out."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    grams, first = {}, {}
    for i, text in rows:
        w = (text or "").lower().split()
        key = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)])
        first.setdefault(key, i)
        grams[i] = key
    sets = sorted(first, key=len)
    root = {s: s for s in sets}

    def top(s):
        while root[s] is not s:
            s = root[s]
        return s

    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            if len(sets[a]) < 0.8 * len(sets[b]):
                break
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                root[top(sets[a])] = top(sets[b])
    want = {}
    for s in sets:
        want[id(top(s))] = min(want.get(id(top(s)), first[s]), first[s])
    assert {r.doc_id for r in N.keep_one_per_class(docs).collect()} == set(want.values()) and len(want) < len(sets)


def test_only_rows_of_like_size_are_compared(monkeypatch):
    """The order by size leaves out pairs that cannot be links, and no other."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, (1, N.FIRST)).astype(np.uint64)
    fps = np.repeat(base, 700, 0) ^ (np.uint64(1) << rng.integers(0, 64, (700, N.FIRST)).astype(np.uint64))  # all are close
    size = np.sort(rng.integers(1, 5000, 700)).astype(np.int32)
    near = (np.minimum(size[:, None], size) >= 0.8 * np.maximum(size[:, None], size)) & ~np.eye(700, dtype=bool)
    compared, real = [], N._close
    monkeypatch.setattr(N, "_close", lambda a, b: compared.append(len(a) * len(b)) or real(a, b))
    assert (N._meets(fps, size, fps, size, True) == near.any(1)).all()
    assert sum(compared) < 0.4 * 700 * 700 / 2
    other = np.sort(rng.integers(1, 9000, 300)).astype(np.int32)
    want = (np.minimum(size[:, None], other) >= 0.8 * np.maximum(size[:, None], other)).any(1)
    assert (N._meets(fps, size, fps[:300], other, False) == want).all()
