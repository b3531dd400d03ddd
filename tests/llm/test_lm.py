import math
import re
import zlib
from collections import Counter

import numpy as np

from strataforge.llm import lm as L


def brute(rows):
    """The base of the contract, word by word."""
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    split = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(split(t)), sum(c[w] > 0 for w in split(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in split(t))) for i, t in rows]


def same(got, rows):
    key = lambda r: repr((r[0], r[2], r[3], round(r[5], 6)))
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for a, b in zip(got, sorted(brute(rows), key=key), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)


def fitted(docs, monkeypatch):
    """scored_documents with the model that it used."""
    seen = []
    real = L.Scorer
    monkeypatch.setattr(L, "Scorer", lambda vocabulary, m: seen.append((vocabulary, m)) or real(vocabulary, m))
    return L.scored_documents(docs).collect(), *seen[-1]


def test_base_against_brute_force_and_model_beats_it(spark, sf, monkeypatch):
    monkeypatch.setattr(L, "HEAD", 3000)  # so that many words go through the join
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = L.scored_documents(docs).collect()
    same(got, [(r.doc_id, r.text) for r in docs.collect()])
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score <= 0 for r in got)


def test_end_is_exact_where_the_head_does_not_reach_it(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(L.HEAD + 1))) for i in (0,) if zlib.crc32(b"0") % 7 != 2]
    assert rows
    same(L.scored_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def blocks_of(spark, texts):
    """Blocks of texts whose ids are all learnt from."""
    ids = [i for i in range(3 * len(texts) + 30) if zlib.crc32(str(i).encode()) % 7 != 2]
    return L.text_blocks(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"))


def numbered(vocabulary, text):
    words = L.tokens(text)
    keys, buckets = np.array([*map(L.key_of, words), L.END], np.int64), np.array([*map(L.bucket_of, words), 0])
    return vocabulary.of(keys, buckets)


def number_of(vocabulary, word):
    return int(numbered(vocabulary, word.decode())[0])


def epochs(trainer, texts, n):
    numbers = [numbered(trainer.v, t) for t in texts]
    for _ in range(n):
        trainer.epoch(np.concatenate(numbers), np.array([len(x) for x in numbers]), 1, 1)


def plain_score(text, counts, vocabulary, m):
    """The model's log10 probability token by token: a softmax over all classes, one over the words of a class, a share of the rest."""
    def softmax(logits):
        e = np.exp(logits - logits.max())
        return e / e.sum()

    past, total = [0, 0], 0.0
    for word in [*L.tokens(text), None]:
        number = 0 if word is None else number_of(vocabulary, word)
        kind = int(vocabulary.kind[number])
        guess = m["R"][past[0]] @ m["C"][0] + m["R"][past[1]] @ m["C"][1]
        p = softmax((m["Q"][:, : L.WIDTH] @ guess + m["Q"][:, L.WIDTH]).astype(np.float64))[kind]
        if kind >= L.SINGLES:
            b = kind - L.SINGLES
            end = vocabulary.first[b + 1] if b + 1 < L.BUCKETS else len(m["W"])
            own = m["W"][vocabulary.first[b] : end]
            inside = softmax((own[:, : L.WIDTH] @ (m["R"][past[0]] @ m["S"]) + own[:, L.WIDTH]).astype(np.float64))
            p *= inside[vocabulary.row[number] - vocabulary.first[b]]
            if vocabulary.row[number] == end - 1:
                p *= (counts[word] + 1) / 10 ** vocabulary.rest_log[b]
        total += math.log10(p)
        past = [kind, past[0]]
    return total


def test_score_against_brute_force(spark, monkeypatch):
    """Single words, words with vectors, head words without, words outside the head and unseen words."""
    monkeypatch.setattr(L, "HEAD", 40)
    monkeypatch.setattr(L, "SINGLES", 6)
    monkeypatch.setattr(L, "BUCKETS", 3)
    monkeypatch.setattr(L, "CLASSES", 9)
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{min(int(x), 400)}" for x in rng.pareto(0.7, rng.integers(1, 80)) * 3)) for i in range(120)] + [(300, None), (301, "unseen Words w1 W2"), (302, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got, vocabulary, m = fitted(docs, monkeypatch)
    counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in L.tokens(t))
    assert (vocabulary.row[:-3] >= 0).sum() > 20 and vocabulary.rest[:-3].any() and len(counts) > 60 and len(vocabulary.word_share) > 6
    text = dict(rows)
    for r in got:
        assert math.isclose(r.score, plain_score(text[r.doc_id], counts, vocabulary, m), rel_tol=1e-4, abs_tol=1e-4)


def test_probabilities_are_normalised(spark):
    """The classes' probabilities add up to one, those of a class's words and rest too, and those of the rest's words with one
    unseen word for each class."""
    words = [f"w{i * i % 97}" for i in range(6000)] + [f"x{i}" for i in range(L.SINGLES)] * 2 + [f"y{i}" for i in range(3000)] * 25 + ["once"]
    vocabulary = L.Vocabulary(L.corpus_counts(blocks_of(spark, [" ".join(words)])))
    rng = np.random.default_rng(0)
    m = {k: v + rng.standard_normal(v.shape).astype(np.float32) * 0.3 for k, v in L.new_model(vocabulary).items()}
    for far in (m, m | {"Q": m["Q"] + 100, "W": m["W"] - 50}):
        scorer = L.Scorer(vocabulary, far)
        for h in rng.integers(0, L.CLASSES, (4, 2)):
            p = np.exp(scorer.class_logs(np.repeat(h[None], L.CLASSES, 0), np.arange(L.CLASSES)))
            assert abs(p.sum() - 1) < 1e-2 if far is not m else abs(p.sum() - 1) < 1e-4
            bucket = np.repeat(np.arange(L.BUCKETS), np.diff(np.r_[vocabulary.first, len(m["W"])]))
            p = np.exp(scorer.word_logs(np.full(len(bucket), h[0]), np.arange(len(bucket)), bucket))
            assert np.allclose(np.bincount(bucket, p), 1, atol=1e-2 if far is not m else 1e-4)
    count = Counter(w.encode() for w in words)
    inside = np.zeros(L.BUCKETS)
    for w, n in count.items():
        if vocabulary.rest[number_of(vocabulary, w)]:
            inside[L.bucket_of(w)] += (n + 1) / 10 ** vocabulary.rest_log[L.bucket_of(w)]
    assert np.allclose(inside + 10**-vocabulary.rest_log, 1)


def test_contexts():
    got = L.contexts(np.array([5, 6, 7, 8, 9]), np.array([0, 3]))
    assert got.tolist() == [[0, 0], [5, 0], [6, 5], [0, 0], [8, 0]]
    assert L.contexts(np.array([5]), np.array([0])).tolist() == [[0, 0]]
    assert L.contexts(np.array([5, 6, 7]), np.array([0, 1, 2])).tolist() == [[0, 0]] * 3


def test_training_learns_what_follows_what(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{(s + i) % 10}" for i in range(30)) for s in rng.integers(0, 10, 400)]
    vocabulary = L.Vocabulary(L.corpus_counts(blocks_of(spark, texts)))
    trainer = L.Trainer(L.new_model(vocabulary), vocabulary)
    epochs(trainer, texts, 80)
    numbers = numbered(vocabulary, texts[0])
    before = L.contexts(numbers, np.array([0]))
    assert np.exp(L.Scorer(vocabulary, trainer.m).class_logs(before, numbers)[3:-1]).mean() > 0.5


def test_words_within_a_class_learn_from_the_class_before(spark, monkeypatch):
    monkeypatch.setattr(L, "SINGLES", 3)
    monkeypatch.setattr(L, "BUCKETS", 1)
    monkeypatch.setattr(L, "CLASSES", 4)
    texts = ["a " * 4 + "a xx " * 10, "b " * 4 + "b yy " * 10] * 200
    vocabulary = L.Vocabulary(L.corpus_counts(blocks_of(spark, texts)))
    trainer = L.Trainer(L.new_model(vocabulary), vocabulary)
    epochs(trainer, texts, 20)
    scorer = L.Scorer(vocabulary, trainer.m)
    a, x, y = (number_of(vocabulary, w) for w in (b"a", b"xx", b"yy"))
    p = np.exp(scorer.word_logs(vocabulary.kind[[a, a]], vocabulary.row[[x, y]], np.zeros(2, int)))
    assert p[0] > 0.8 and p[1] < 0.2


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "A a\tb É é"), (4, "x " * 300000), (5, "rare words here"), (6, " \n ")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, N_tokens int")
    same(L.scored_documents(docs).collect(), rows)
    assert L.scored_documents(docs.limit(0)).count() == 0
    only = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    same(L.scored_documents(spark.createDataFrame([(i, "a b") for i in only], "doc_id long, text string")).collect(), [(i, "a b") for i in only])


def test_model_learns_in_the_tasks_and_slices_add_up(spark, monkeypatch):
    texts = ["one two three"] * 20000
    blocks = blocks_of(spark, texts)
    vocabulary = L.Vocabulary(L.corpus_counts(blocks))
    numbers = numbered(vocabulary, texts[0])
    m = L.train_on_all(blocks, vocabulary)
    p = np.exp(L.Scorer(vocabulary, m).class_logs(L.contexts(numbers, np.array([0])), numbers))
    assert (p > 0.3).all(), "the model learns from the tasks"
    start = L.new_model(vocabulary)
    again = L.train_on_all(blocks.limit(0), vocabulary)
    assert all((again[k] == v).all() for k, v in start.items())
    assert all((L._unpacked(L._packed(start))[k] == v).all() for k, v in start.items())
    one = L.train(blocks, start, vocabulary, 0.5, 0.1)
    monkeypatch.setattr(L, "SLICE", 100)
    other = L.train(blocks, start, vocabulary, 0.5, 0.1)
    assert all(np.allclose(one[k], v, atol=1e-5) for k, v in other.items())
    still = np.setdiff1d(np.arange(L.CLASSES), vocabulary.kind[numbers])
    assert (one["R"][still] == start["R"][still]).all(), "what no task trained stays as it began"


def test_blocks_hold_every_text_and_small_blocks_change_no_count(spark, monkeypatch):
    rows = [(i, f"w{i % 7} W{i % 11} end") for i in range(400)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(L.scored_documents(docs).collect(), rows)
    monkeypatch.setattr(L, "BLOCK", 5)
    assert L.text_blocks(docs).count() > 100
    same(L.scored_documents(docs).collect(), rows)


def test_every_training_text_of_a_larger_corpus_is_trained_on(spark):
    rows = [(i, "common words only") for i in range(6000)]
    blocks = L.text_blocks(spark.createDataFrame(rows, "doc_id long, text string"))
    vocabulary = L.Vocabulary(L.corpus_counts(blocks))
    assert vocabulary.tokens == 4 * sum(zlib.crc32(str(i).encode()) % 7 != 2 for i in range(6000))
    trainer = L.Trainer(L.new_model(vocabulary), vocabulary)
    for r in blocks.collect():
        train, sizes = np.frombuffer(bytes(r.train), bool), np.frombuffer(bytes(r.sizes), np.int64)
        flat = vocabulary.texts(bytes(r.numbers), bytes(r["keys"]), bytes(r.buckets))[0]
        trainer.epoch(flat[np.repeat(train, sizes)], sizes[train], 1, 1)
    assert trainer.tokens == vocabulary.tokens
