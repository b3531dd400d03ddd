"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

Words are compared in lower case without ASCII punctuation. One pass over the corpus counts in how many documents each SEED-gram
of the benchmark occurs. Of every stretch of STRETCH consecutive n-grams of an item the RAREST ones become seeds, so every part
of an item has seeds, however common it is. A second pass joins documents to items on seeds (a hash join whose small side, the
seeds of a block of items, is held by each task) and aligns the words around every hit with the whole item: a match scores 1, a
substituted, added or left out word costs 1. A document is contaminated by an item if the best local alignment scores SHARE of
the item's length but LEAST words, or LONG words. What cannot reach that, by the number of the item's words in the window, is not
aligned. Items of fewer than LEAST words must stand in a document as they are, every word in order; they are found by a hash of the
whole item over all runs of that many words, then compared.

The benchmark is taken in blocks of at most about BLOCK_ITEMS items and BLOCK_CHARS characters, each with its own two passes,
so a task's memory does not grow with it. Texts are never shuffled, and hits are aligned where they are found, so a passage
that a third of all documents share costs each of them one alignment.

Edge cases: an item without words is in no document; null or empty texts contain nothing; items that
repeat are found each; repeated rows are judged each; very long documents are read whole; other columns pass through; with an
empty benchmark nothing is contaminated, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.common import Shared

SEED = 3
STRETCH, RAREST = 6, 3
SHARE, LONG = 0.5, 30
LEAST = 6
BLOCK_ITEMS, BLOCK_CHARS = 5000, 8 << 20
#: Bytes that become spaces: ASCII that is neither letter nor digit; A-Z are lower already.
PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
FOUND = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType())]))


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(PLAIN).split()


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """The best local alignment's score and its last place in words. Rows of the table are items' words; within a row, gaps
    are a running maximum."""
    ramp = np.arange(1, len(words) + 1)
    above, best, at = np.zeros(len(words) + 1, np.int64), 0, -1
    for w in item:
        here = np.maximum(np.maximum(above[:-1] + np.where(words == w, 1, -1), above[1:] - 1), 0)
        above = np.r_[0, np.maximum.accumulate(here + ramp) - ramp]
        top = int(above.argmax())
        if above[top] > best:
            best, at = int(above[top]), top - 1
    return best, at


class Index:
    """Items of a block as word numbers (0: a word of no item), their n-grams as sorted numbers, and where those occur."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.items = [], []
        for item_id, text in items:
            found = plain_words(text)
            if found:
                self.ids.append(item_id)
                self.items.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found], np.int64))
        self.short: dict[int, dict[int, list[int]]] = {}  # by length and hash
        for i, item in enumerate(self.items):
            if len(item) < LEAST:
                self.short.setdefault(len(item), {}).setdefault(int(self.runs(item, len(item))[0]), []).append(i)
        self.hashes = {n: np.sort(np.fromiter(x, np.uint64, len(x))) for n, x in self.short.items()}
        places = [(g, i, p) for i, item in enumerate(self.items) if len(item) >= LEAST for p, g in enumerate(self.grams(item)[1].tolist())]
        self.keys, number = np.unique(np.array([x[0] for x in places], np.int64), return_inverse=True)
        self.places = [[] for _ in self.keys]
        for k, (_, i, p) in zip(number.tolist(), places, strict=True):
            self.places[k].append((i, p))
        self.seed = np.ones(len(self.keys), bool)

    @staticmethod
    def runs(ids: np.ndarray, n: int) -> np.ndarray:
        """Hashes of all runs of n words."""
        out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
        for k in range(n):
            out = (out ^ ids[k : k + len(out)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    def whole(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Short items that ids contain as they are, with the first place of each."""
        for n, known in self.hashes.items():
            found = self.runs(ids, n)
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, found), len(known) - 1)] == found)
            at = at[np.sort(np.unique(found[at], return_index=True)[1])]
            for p in at.tolist():
                yield from ((i, p) for i in self.short[n][int(found[p])] if np.array_equal(self.items[i], ids[p : p + n]))

    def grams(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the n-grams that consist of items' words only."""
        if len(ids) < SEED:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = ids > 0
        whole = np.flatnonzero(known[: len(ids) - 2] & known[1:-1] & known[2:])
        base = len(self.vocabulary) + 1  # at most 2**21 words of a block, by BLOCK_CHARS
        return whole, (ids[whole] * base + ids[whole + 1]) * base + ids[whole + 2]

    def numbers(self, text: str | None) -> np.ndarray:
        found = plain_words(text)
        return np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.int64, len(found))

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a document and key numbers of its n-grams that items have."""
        at, grams = self.grams(ids)
        if not len(self.keys) or not len(at):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        same = self.keys[k] == grams
        return at[same], k[same]

    def choose(self, documents: np.ndarray) -> None:
        """Keeps the rarest n-grams of every stretch as seeds, by the number of documents that have each."""
        self.seed[:] = False
        for item in (x for x in self.items if len(x) >= LEAST):
            k = np.searchsorted(self.keys, self.grams(item)[1])
            for s in range(max(1, len(k) - STRETCH + 1)):
                part = k[s : s + STRETCH]
                self.seed[part[np.argsort(documents[part], kind="stable")[:RAREST]]] = True

    def search(self, text: str | None) -> list[tuple]:
        """(item_id, share of the item aligned, first and last word of the alignment) for each item in a text."""
        ids = self.numbers(text)
        at, k = self.hits(ids)
        chosen = self.seed[k]
        windows: dict[int, list[tuple[int, int]]] = {}
        for place, key in zip(at[chosen].tolist(), k[chosen].tolist(), strict=True):
            for i, p in self.places[key]:
                m = len(self.items[i])
                lo, hi = max(0, place - p - m // 2), min(len(ids), place - p + m + m // 2)
                spans = windows.setdefault(i, [])
                if spans and lo <= spans[-1][1]:
                    spans[-1] = (min(lo, spans[-1][0]), max(hi, spans[-1][1]))
                else:
                    spans.append((lo, hi))
        out = [(self.ids[i], 1.0, p, p + len(self.items[i]) - 1) for i, p in self.whole(ids)]
        for i, spans in sorted(windows.items()):
            item, best = self.items[i], (0, 0, 0)
            need = min(max(SHARE * len(item), LEAST), LONG)
            own = np.unique(item)
            for lo, hi in spans:
                part = ids[lo:hi]
                if np.isin(part, own).sum() < max(need, best[0] + 1):
                    continue
                score, end = align(item, part)
                if score > best[0]:
                    back, start = align(item[::-1], part[: end + 1][::-1])
                    best = (score, lo + end - start, lo + end)
            if best[0] >= need:
                out.append((self.ids[i], best[0] / len(item), best[1], best[2]))
        return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The items, by blocks that fit on the driver."""
    rows = benchmark.select("item_id", "text")
    count, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    n = max(1, -(-count // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    for b in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else rows
        yield sorted(((r.item_id, r.text) for r in part.collect()), key=repr)


def _document_counts(docs: DataFrame, text: str, index: Index) -> np.ndarray:
    shared = Shared(docs.sparkSession, index)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value.keys), np.int64)
        for batch in batches:
            for x in batch.column(0):
                total[np.unique(shared.value.hits(shared.value.numbers(x.as_py()))[1])] += 1
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["k", "n"])

    out = np.zeros(len(index.keys), np.int64)
    for r in docs.select(text).mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r.k] = r.n
    return out


def _search(shared):
    names = [f.name for f in FOUND.elementType]
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())]))

    @F.arrow_udf(FOUND)
    def search(column: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(names, x, strict=True)) for x in shared.value.search(t.as_py())] for t in column], kind)

    return search


def found_items(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> Column:
    """An array of what items a document contains, to select from docs."""
    columns = []
    for items in _blocks(benchmark):
        index = Index(items)
        if not index.items:
            continue
        if len(index.keys):
            index.choose(_document_counts(docs, text, index))
        columns.append(_search(Shared(docs.sparkSession, index))(F.col(f"`{text}`")))
    return F.concat(*columns) if columns else F.array().cast(FOUND)


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score and the aligned words' places, for each item that a document contains."""
    docs = docs.select("doc_id", "text")
    return docs.select("doc_id", F.explode(found_items(docs, benchmark)).alias("found")).select("doc_id", "found.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that contain no item, with the columns of docs."""
    return docs.filter(F.size(found_items(docs, benchmark)) == 0)
