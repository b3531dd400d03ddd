import math
import zlib
from collections import Counter

import numpy as np

from strataforge.llm import langid as L


def test_held_out_accuracy_and_contract(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in L.predicted_languages(docs).collect()}
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    assert rows.keys() == truth.keys()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (not any(c.isalpha() for c in truth[i][1] or ""))
    held = [rows[i].lang_pred == truth[i][0] for i in rows if rows[i].held_out and rows[i].lang_pred != "und"]
    assert np.mean(held) > 0.95


ROWS = [("a", 0, "cat", 6), ("b", 0, "cat", 2), ("b", 0, "dog", 8), ("a", 1, "c", 5), ("b", 1, "d", 5), ("a", 2, "ca", 4), ("a", 3, "^ca", 4), ("b", 2, "do", 4)]


def test_word_first_then_shorter_ngrams():
    model = L.Model(["a", "b"], ROWS)

    def p(lang, size, entry):
        own = [r for r in ROWS if r[1] == size]
        n = sum(r[3] for r in own if r[0] == lang)
        kinds = len({r[2] for r in own}) + (size == 1)  # and the unknown character
        c = sum(r[3] for r in own if r[0] == lang and r[2] == entry)
        return math.log((c + 0.5) / (n + 0.5 * kinds + 1))

    def word(lang, w):
        if w in ("cat", "dog"):
            return p(lang, 0, w)
        marked, out = f"^{w}$", []
        for i in range(len(marked)):
            known = [g for g in ("^ca", "ca", "do", "c", "d") if marked.startswith(g, i)]
            out.append(p(lang, len(max(known, key=len)), max(known, key=len)) if known else p(lang, 1, "?"))
        return sum(out) / len(out)

    text = "Cat cab dode CAT zz"
    points = [sum(word(x, w) for w in text.lower().split()) for x in "ab"]
    (got,) = L.predict([text], model)
    assert got[0] == "ab"[int(np.argmax(points))]
    assert math.isclose(got[1], 1 / (1 + math.exp(-abs(points[0] - points[1]))), rel_tol=1e-9)


def test_parts_and_caches_change_nothing(monkeypatch):
    model = L.Model(["a", "b"], ROWS)
    texts = [None, "", "12 !", "cat", "dog cab " * 500, "catalog dogma cabbage " * 90]
    want = list(L.predict(texts, model))
    assert want[:3] == [("und", 0.0)] * 3
    monkeypatch.setattr(L, "CACHED", 1)
    monkeypatch.setattr(L, "PART", 37)
    for t, w in zip(texts * 2, want * 2, strict=True):
        (got,) = L.predict([t], model)
        assert got[0] == w[0] and math.isclose(got[1], w[1], rel_tol=1e-6)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "en", 1), (2, "", "en", 1), (None, "hello", None, 2), (3, "hello", None, 2), (3, "hello", None, 2)], "doc_id long, text string, lang string, Score int")
    assert {(r.lang_pred, r.score) for r in L.predicted_languages(docs).collect()} == {("und", 0.0)}
    assert L.predicted_languages(docs.limit(0)).count() == 0
    more = docs.unionByName(spark.createDataFrame([(i, "hello world again", "en", 0) for i in range(9)] + [(20 + i, "hallo welt " * 90000, "de", 0) for i in range(3)], docs.schema))
    got = [r for r in L.predicted_languages(more).collect() if r.doc_id == 3]
    assert len(got) == 3 and {r.lang_pred for r in got} == {"en"}


def test_numerals_are_no_letters(spark):
    rows = [(i, t, "xx") for i, t in enumerate(["\u00bd \u00b2", "\u2460 \u2167 12", "a\u00bdb"] * 4)] + [(20 + i, "plain words here", "en") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in L.predicted_languages(docs).collect()}
    for i, text, _ in rows:
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in text)), text
    assert list(L.letter_words("a\u00bdb \u2167 cd\u0964")) == [["a", "b", "cd"]]
    only = spark.createDataFrame([(i, "\u00bd \u00b2 \u2460", "xx") for i in range(9)], docs.schema)
    assert {(r.lang_pred, r.score) for r in L.predicted_languages(only).collect()} == {("und", 0.0)}


def plain_model(rows):
    """Counts of a small training table, read whole."""
    words, grams = Counter(), Counter()
    for i, text, lang in rows:
        if lang is None or text is None or zlib.crc32(str(i).encode()) % 4 == 2:
            continue
        for w in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            words[lang, w] += 1
            m = f"^{w}$"
            for n in range(1, L.LONGEST + 1):
                for k in range(len(m) - n + 1):
                    grams[lang, m[k : k + n]] += 1
    return words, grams


def test_whole_table_against_brute_force(spark, sf, monkeypatch):
    """Every document's points from plain counts, word by word and place by place."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(120)
    docs = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in docs.collect()], "doc_id long, text string, lang string")
    rows = [tuple(r) for r in docs.collect()]
    words, grams = plain_model(rows)
    langs = sorted({k[0] for k in words})
    seen, known = Counter(), Counter()
    for (_, w), n in words.items():
        seen[w] += n
    for (_, g), n in grams.items():
        known[g] += n
    seen = {w for w, n in seen.items() if n >= L.WORD_SEEN}
    known = {g for g, n in known.items() if n >= (1 if len(g) == 1 else L.GRAM_SEEN)}
    total = {(x, 0): sum(n for (y, w), n in words.items() if y == x and w in seen) for x in langs}
    total |= {(x, k): sum(n for (y, g), n in grams.items() if y == x and len(g) == k and g in known) for x in langs for k in range(1, L.LONGEST + 1)}
    kinds = Counter({0: len(seen), 1: 1}) + Counter(map(len, known))
    p = lambda c, x, k: math.log((c + 0.5) / (total[x, k] + 0.5 * kinds[k] + 1))

    def points(word):
        if word in seen:
            return np.array([p(words[x, word], x, 0) for x in langs])
        m, out = f"^{word}$", []
        for i in range(len(m)):
            g = next((m[i : i + n] for n in range(min(L.LONGEST, len(m) - i), 0, -1) if m[i : i + n] in known), None)
            out.append([p(grams[x, g], x, len(g)) if g else p(0, x, 1) for x in langs])
        return np.mean(out, 0)

    got = {r.doc_id: r for r in L.predicted_languages(docs).collect()}
    for i, text, _ in rows:
        found = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        if not found:
            assert got[i].lang_pred == "und"
            continue
        all_points = sum(points(w) for w in found)
        assert got[i].lang_pred == langs[int(np.argmax(all_points))]
        assert math.isclose(got[i].score, 1 / np.exp(all_points - all_points.max()).sum(), rel_tol=1e-6)


def test_long_runs_are_learnt_whole_and_one_id_does_not_fill_the_sample(spark):
    from pyspark.sql import functions as F

    run = "ab" * 40 + "qz"
    docs = spark.createDataFrame([(i, run, "xx") for i in range(8)] + [(20 + i, "plain words", "en") for i in range(8)], "doc_id long, text string, lang string")
    model = L.learn(docs)
    assert {"qz$", "bqz$"} <= model.grams.keys()
    many = spark.range(300_000).select(F.lit(1).alias("doc_id"), F.concat(F.lit("word "), F.col("id") % 60_000).alias("text"), F.lit("en").alias("lang"))
    assert L.learn(many, per_language=100).langs == ["en"]
