"""Language identification: known words by per-language log frequency, unseen words by ever shorter character n-grams.

Words are runs of letters (Unicode's categories L; numerals such as a half or a Roman two are none) in lower case. A word seen at least WORD_SEEN times in the sample is known and scores the logarithm
of its smoothed relative frequency in each language. Any other word is read as ^word$; at each place the longest known n-gram of
LONGEST down to 1 characters scores the logarithm of its smoothed frequency among n-grams of that length, and the word gets the
mean over its places. Scores of words add up over the whole text; the softmax over languages is the score.

Learning takes about PER_LANGUAGE different documents of each language, chosen by the least hashes of their ids and texts (a
fraction by language from exact counts, so a rare language is taken whole and a hot one costs no more), and reads them whole; counts
are summed before and in a shuffle and only what was seen often enough reaches the driver, the model's size being MOST_ENTRIES most
frequent entries of a language and length at most.
Prediction is one pass without a shuffle.

Edge cases: a text that is null or has no letter is `und` with score 0; a null lang or a text without letters teaches nothing; without
anything learned every text is `und`; equal scores go to the first language in order; repeated rows get equal results; other columns are ignored,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.common import Shared, remainder

PER_LANGUAGE = 1500
WORD_SEEN, GRAM_SEEN = 2, 3
LONGEST = 5
MOST_ENTRIES = 60_000
CACHED = 200_000
LETTERS = re.compile(r"[^\W\d_]+")
#: Characters of a text read at once; a word that a cut would split goes to the next part.
PART = 1 << 20


def letter_words(text: str | None) -> Iterator[list[str]]:
    """The words of a whole text, by parts."""
    text, at = text or "", 0
    while at < len(text):
        end = min(len(text), at + PART)
        while end < len(text) and end < at + 2 * PART and text[end].isalpha():
            end += 1
        found = LETTERS.findall(text[at:end].lower())
        if not "".join(found).isalpha() and found:  # numerals that are no digits count as word characters too
            found = [w for x in found for w in "".join(c if c.isalpha() else " " for c in x).split()]
        yield found
        at = end


def grams(word: str) -> Iterator[str]:
    marked = f"^{word}$"
    for n in range(1, LONGEST + 1):
        for i in range(len(marked) - n + 1):
            yield marked[i : i + n]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts by language, length (0: words) and entry."""
    def table(total: Counter) -> pa.RecordBatch:
        keys = list(total)
        return pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.string()), pa.array([total[k] for k in keys], pa.int64())], ["lang", "size", "entry", "n"])

    for batch in batches:
        total: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            for part in letter_words(text.as_py()):
                for word, n in Counter(part).items():
                    total[lang, 0, word] += n
                    for g in grams(word):
                        total[lang, len(g), g] += n
            if len(total) > 500_000:
                yield table(total)
                total = Counter()
        yield table(total)


class Model:
    """Entries' rows in a matrix of log frequencies by language."""

    def __init__(self, langs: list[str], rows: list[tuple[str, int, str, int]]):
        self.langs = langs
        column = {x: i for i, x in enumerate(langs)}
        self.words: dict[str, int] = {}
        self.grams: dict[str, int] = {}
        sizes: list[int] = []
        for _, size, entry, _ in rows:
            into = self.words if size == 0 else self.grams
            if entry not in into:
                into[entry] = len(sizes)
                sizes.append(size)
        counts = np.zeros((len(sizes) + 1, len(langs)))  # the last row: a character that no language has
        for lang, size, entry, n in rows:
            counts[(self.words if size == 0 else self.grams)[entry], column[lang]] += n
        kind = np.array([*sizes, 1], np.int64)
        totals = np.zeros((LONGEST + 1, len(langs)))
        np.add.at(totals, kind, counts)
        known = np.bincount(kind, minlength=LONGEST + 1)[:, None]
        self.table = np.log((counts + 0.5) / (totals + 0.5 * known + 1)[kind])

    def backoff(self, word: str) -> list[int]:
        """Rows of the longest known n-gram at each place."""
        marked, find, out = f"^{word}$", self.grams.get, []
        for i in range(len(marked)):
            for n in range(min(LONGEST, len(marked) - i), 0, -1):
                row = find(marked[i : i + n])
                if row is not None:
                    out.append(row)
                    break
            else:
                out.append(len(self.table) - 1)
        return out


class Scores(dict):
    """word -> row in a growing matrix of scores; unseen words are queued and filled in together."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.update(self.model.words)
        self.extra, self.queue = [self.model.table], []
        self.next = len(self.model.table)

    def __missing__(self, word: str) -> int:
        self[word] = row = self.next + len(self.queue)
        self.queue.append(self.model.backoff(word))
        return row

    def rows(self) -> np.ndarray:
        if self.queue:
            sizes = np.fromiter(map(len, self.queue), np.int64, len(self.queue))
            flat = np.fromiter((r for q in self.queue for r in q), np.int64, int(sizes.sum()))
            means = np.add.reduceat(self.model.table[flat], np.cumsum(sizes) - sizes) / sizes[:, None]
            self.extra = [np.concatenate([*self.extra, means])]
            self.next += len(self.queue)
            self.queue = []
        return self.extra[0]


def predict(texts, model: Model) -> Iterator[tuple[str, float]]:
    scores, waiting = Scores(model), []

    def results():
        rows = scores.rows()
        for total in waiting:
            if total is None:
                yield "und", 0.0
                continue
            points = sum(np.bincount(ids) @ rows[: ids.max() + 1] if len(ids) > len(rows) else rows[ids].sum(0) for ids in total)
            best = int(np.argmax(points))
            yield model.langs[best], float(1 / np.exp(points - points[best]).sum())

    held = 0
    for text in texts:
        parts = [np.fromiter(map(scores.__getitem__, p), np.int64, len(p)) for p in letter_words(text) if p] if model.langs else []
        waiting.append(parts or None)
        held += sum(map(len, parts))
        if held > 200_000 or len(waiting) >= 1000:
            yield from results()
            waiting, held = [], 0
            if len(scores) - len(model.words) > CACHED:
                scores.restart()
    yield from results()


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """docs: doc_id, text, lang."""
    train = docs.filter("lang is not null and text is not null").filter(remainder(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang")
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    # the fraction keeps a few more than asked for; the window below, over those alone, makes it exact
    some = F.lit(False)
    for r in train.groupBy("lang").count().collect():
        some = some | ((F.col("lang") == r.lang) & (place < min(1.0, (1.2 * per_language + 50) / r["count"])))
    ids = train.filter(some).select("lang", place.alias("place")).distinct().withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("place")))
    last = {r.lang: r.last for r in ids.filter(F.col("k") <= per_language).groupBy("lang").agg(F.max("place").alias("last")).collect()}
    if not last:
        return Model([], [])
    taken = F.lit(False)
    for lang, value in last.items():
        taken = taken | ((F.col("lang") == lang) & (place <= value))
    counted = train.filter(taken).select("lang", "text").mapInArrow(_count, "lang string, size int, entry string, n long")
    counted = counted.groupBy("lang", "size", "entry").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("size", "entry"))
    often = counted.withColumn("total", total).filter(F.col("total") >= F.when(F.col("size") == 0, WORD_SEEN).when(F.col("size") == 1, 1).otherwise(GRAM_SEEN))
    top = often.withColumn("k", F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "entry"))).filter(F.col("k") <= MOST_ENTRIES)
    table = top.select("lang", "size", "entry", "n").toArrow()
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("lang", "size", "entry", "n")), strict=True))
    return Model(sorted({r[0] for r in rows}), rows)


def with_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds a struct column `language` with lang_pred and score; docs must have no column of that name."""
    if "language" in map(str.lower, docs.columns):
        raise ValueError("docs has a column `language` already")
    shared = Shared(docs.sparkSession, model)

    @F.arrow_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def of(column: pa.Array) -> pa.Array:
        out = list(predict((x.as_py() for x in column), shared.value))
        return pa.StructArray.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], ["lang_pred", "score"])

    return docs.withColumn("language", of(F.col(text)))


def predicted_languages(docs: DataFrame) -> DataFrame:
    out = with_language(docs.select("doc_id", "text"), learn(docs))
    return out.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "language.lang_pred", "language.score")
