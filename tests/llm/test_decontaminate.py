import random

import numpy as np

from strataforge.llm import decontaminate as D


def plain_align(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_against_the_full_table():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(1, 5, rng.integers(1, 15)), rng.integers(0, 5, rng.integers(1, 30))
        score, end = D.align(a, b)
        assert score == plain_align(a.tolist(), b.tolist())
        if score:
            back, start = D.align(a[::-1], b[: end + 1][::-1])
            assert back == score == plain_align(a.tolist(), b[end - start : end + 1].tolist())


def brute(docs, items):
    """Every document against every item, no seeds."""
    out = set()
    for d, text in docs:
        words = D.plain_words(text)
        for i, item in items:
            own = D.plain_words(item)
            if 0 < len(own) < D.LEAST:
                if any(words[k : k + len(own)] == own for k in range(len(words) - len(own) + 1)):
                    out.add((d, i))
            elif len(set(words) & set(own)) >= 2:
                vocabulary = {w: k for k, w in enumerate(own, 1)}
                a, b = (np.array([vocabulary.get(w, 0) for w in x]) for x in (own, words))
                if D.align(a, b)[0] >= min(max(D.SHARE * len(own), D.LEAST), D.LONG):
                    out.add((d, i))
    return out


def test_whole_table_against_brute_force(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in D.contaminated_documents(docs, items).collect()}
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and want


def test_edited_copies_blocks_and_common_passages(spark, monkeypatch):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(40))) for i in range(6)]

    def edited(text, every):
        w = text.split()
        for k in range(3, len(w), every):
            w[k] = rng.choice([word(), "", word() + " " + word()])
        return " ".join(w)

    noise = lambda: " ".join(word() for _ in range(60))
    docs = [(10 + i, f"{noise()} {edited(t, 8).upper()}! {noise()}") for i, t in items] + [(100 + k, f"{noise()}\n{items[0][1]}\n{noise()}") for k in range(40)] + [(200 + k, noise()) for k in range(40)]
    want = {(10 + i, i) for i, _ in items} | {(100 + k, 0) for k in range(40)}
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.contaminated_documents(d, b).collect()} == want
    clean = {r.doc_id for r in D.keep_clean(d, b).collect()}
    assert clean == {200 + k for k in range(40)}
    monkeypatch.setattr(D, "BLOCK_ITEMS", 2)
    assert {(r.doc_id, r.item_id) for r in D.contaminated_documents(d, b).collect()} == want


def test_edge_cases(spark):
    item = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, f"x {item}", 2), (3, f"x {item}", 2), (None, item.upper(), 3), (4, "a " * 200000 + item, 3)], "doc_id long, text string, Item_ID int")
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (9, ""), (10, "x"), (None, item)], "item_id long, text string")
    got = D.contaminated_documents(docs, items)
    assert got.columns == ["doc_id", "item_id", "score", "first_word", "last_word"]
    want = [(d, i) for d in ("3", "3", "None", "4") for i in ("7", "7", "None")] + [("3", "10")] * 2  # the one word of item 10
    assert sorted((repr(r.doc_id), repr(r.item_id)) for r in got.collect()) == sorted(want)
    assert {(r.first_word, r.last_word, r.score) for r in got.collect() if r.doc_id == 3 and r.item_id != 10} == {(1, 8, 1.0)}
    kept = D.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert D.contaminated_documents(docs, items.limit(0)).count() == 0 and D.contaminated_documents(docs.limit(0), items).count() == 0


def test_short_items_against_brute_force(spark, monkeypatch):
    """Items of 1 to 12 words over few words: below LEAST as they are, above with LEAST words at least."""
    rng = random.Random(2)
    text = lambda n, kinds: " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))
    items = [(i, text(1 + i % 12, 9)) for i in range(60)]
    docs = [(k, text(rng.randrange(40), 9 if k % 2 else 60)) for k in range(150)] + [(200 + i, f"x {t.upper()}, y") for i, t in items]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    for most in (5000, 7):
        monkeypatch.setattr(D, "BLOCK_ITEMS", most)
        got = {(r.doc_id, r.item_id) for r in D.contaminated_documents(d, b).collect()}
        short = {i for i, t in items if len(t.split()) < D.LEAST}
        assert {x for x in got if x[1] in short} == {x for x in want if x[1] in short}
        assert got <= want and {(200 + i, i) for i, _ in items} <= got
