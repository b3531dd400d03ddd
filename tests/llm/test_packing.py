import random
from collections import Counter, defaultdict

from strataforge.llm import packing as P


def piece_by_piece(lengths, sizes, price):
    """Best-fit decreasing, one piece at a time."""
    bins, todo = [], sorted(lengths, reverse=True)
    for k, n in enumerate(todo):
        fits = [b for b in bins if b[0] - sum(b[1]) >= n]
        if fits:
            min(fits, key=lambda b: b[0] - sum(b[1]))[1].append(n)
            continue
        left = todo[k + 1 :]

        def rate(size, n=n, left=left):
            filled = n + min(size - n, sum(x for x in left if x <= size - n))
            return price(min(s for s in sizes if s >= filled)) / filled, size

        bins.append([min((s for s in sizes if s >= n), key=rate), [n]])
    return Counter((min(s for s in sizes if s >= sum(b[1])), tuple(sorted(b[1]))) for b in bins)


def by_plan(lengths, sizes, price):
    plan, bins, seen = P.pack(Counter(lengths), sizes, price), defaultdict(list), Counter()
    for n in lengths:
        number, offset, size = (x[0] for x in plan.place(P.np.array([n]), P.np.array([seen[n]])))
        seen[n] += 1
        bins[number].append((offset, n, size))
    for content in bins.values():
        at = 0
        for offset, n, size in sorted(content):
            assert offset == at
            at += n
        assert at <= size and len({c[2] for c in content}) == 1
    return Counter((c[0][2], tuple(sorted(x[1] for x in c))) for c in bins.values())


def test_same_bins_as_piece_by_piece():
    rng = random.Random(2)
    prices = [P.cost, lambda s: s, lambda s: 5 + s, lambda s: 1 + s * s, lambda s: s**0.5]
    for trial in range(300):
        sizes = sorted(rng.sample(range(3, 60), rng.randrange(1, 5)))
        lengths = [rng.randrange(1, rng.choice([4, sizes[-1] + 1])) if sizes[-1] > 4 else rng.randrange(1, sizes[-1] + 1) for _ in range(rng.randrange(0, 60))]
        lengths = [min(n, sizes[-1]) for n in lengths]
        price = prices[trial % len(prices)]
        assert by_plan(lengths, sizes, price) == piece_by_piece(lengths, sizes, price), (sizes, lengths)


def check(rows, docs, sizes):
    """Pieces cover every document; bins are disjoint, dense from 0 and as small as permitted."""
    want = Counter((i, len((t or "").encode().split()) + 1) for i, t in docs)
    pieces = Counter()
    for r in rows:
        pieces[r.doc_id] += r.n_tokens
    total = Counter()
    for (i, n), k in want.items():
        total[i] += n * k
    assert pieces == total
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append((r.bin_offset, r.n_tokens, r.bin_size))
    assert sorted(bins) == list(range(len(bins)))
    for content in bins.values():
        at = 0
        for offset, n, _ in sorted(content):
            assert offset == at
            at += n
        assert {c[2] for c in content} == {min(s for s in sizes if s >= at)}
    return bins


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    rows = P.packed_documents(docs).collect()
    bins = check(rows, pairs, P.SIZES)
    assert sum(r.n_tokens for r in rows) > 0.9 * sum(c[0][2] for c in bins.values())
    lengths = [r.n_tokens for r in rows]
    assert Counter((c[0][2], tuple(sorted(x[1] for x in c))) for c in bins.values()) == piece_by_piece(lengths, P.SIZES, P.cost)


def test_edge_cases_and_texts(spark):
    rows = [(1, None, 1), (2, "", 1), (2, "", 1), (None, "a b", 1), (3, " a  b\nc " * 50, 2), (4, "w " * 8, 2), (5, "w " * 7 + "é", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Bin_ID int")
    got = P.packed_documents(docs, sizes=(4, 8), texts=True).collect()
    check(got, [(r[0], r[1]) for r in rows], (4, 8))
    for i, text, _ in rows:
        if i not in (2, None):
            assert "".join(r.text for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)) == (text or "")
            assert all(len(r.text.split()) == r.n_tokens - (r.first_token + r.n_tokens > len((text or "").split())) for r in got if r.doc_id == i)
    assert P.packed_documents(docs.limit(0)).count() == 0


def test_rows_of_one_id_are_spread(spark):
    from pyspark.sql import functions as F

    docs = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three").alias("text"))
    old, P.RANKED = P.RANKED, 50
    try:
        rows = P.packed_documents(docs).collect()
        pieces = P._salted(docs.select(F.lit(4).cast("long").alias("n_tokens"), F.monotonically_increasing_id().alias("number")), {4: 4000})
        sizes = [r["count"] for r in pieces.groupBy("n_tokens", "salt").count().collect()]
    finally:
        P.RANKED = old
    assert len(sizes) == 80 and max(sizes) < 100 and sum(sizes) == 4000
    check(rows, [(7, "one two three")] * 4000, P.SIZES)
