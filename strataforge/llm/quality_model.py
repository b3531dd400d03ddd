"""Quality classifier: gated-attention multiple-instance learning over the passages of a document.

A document is a bag of passages of PASSAGE words. The encoder hashes the words of a passage and their shapes (case, digits,
symbols) into FEATURES square-rooted frequencies, with a few plain statistics, and maps them by a learned layer to HIDDEN
numbers. Gated attention (a tanh and a sigmoid branch) weighs the passages, the weighted sum is classified, and all layers are
learned together from document labels alone (Adam in numpy).

Learning takes at most SAMPLE labelled documents, half of each label, those with the least hashes of their ids and as many as
have SAMPLE_PASSAGES passages together, which bounds the driver's part at any input size; each that is taken is learnt from whole.
Rows that repeat an id and its text count once. Scoring takes every passage of every document, in one pass without a shuffle, long
texts by blocks.

Edge cases: a null or empty text is a bag with one empty passage and gets a score; labels that are null or contradict each other
for one id (no majority) teach nothing; without both labels in the sample the score is the share of label 1 in it, without any
sample 0.5; repeated rows get the same score; other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.common import Shared, free_name, remainder, words

PASSAGE = 64
WORD_SLOTS, SHAPE_SLOTS, STATS = 192, 56, 8
FEATURES = WORD_SLOTS + SHAPE_SLOTS + STATS
HIDDEN, GATES = 32, 16
SAMPLE = 6000
SAMPLE_PASSAGES = 200_000
EPOCHS, RATE, BATCH = 30, 0.004, 128
BLOCK = 2048  # passages encoded at once
CACHED = 300_000


def shape(word: str) -> str:
    """The kinds of a word's characters, runs made one: `Word` -> Aa, `U.S.!!` -> A.A.!"""
    if word.isalpha():
        return "a" if word.islower() else "A" if word.isupper() else "Aa" if word[1:].islower() else "aA"
    out = []
    for c in word:
        k = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


class Codes(dict):
    """word (UTF-8) -> 32 bits of hash, length, shape slot and word slot in one integer."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        text = word.decode("utf-8", "replace")
        h = xxhash.xxh64_intdigest(word.lower(), 7)
        kind = xxhash.xxh64_intdigest(shape(text).encode("utf-8", "replace"), 11) % SHAPE_SLOTS
        self[word] = code = (xxhash.xxh64_intdigest(word, 13) & 0x7FFFFFFF) << 32 | min(len(text), 255) << 16 | kind << 8 | h % WORD_SLOTS
        return code


def encode(text: str | None, codes: Codes) -> Iterator[np.ndarray]:
    """Features of the passages of a text, by blocks."""
    found = (text or "").encode("utf-8", "replace").split()
    n = max(1, -(-len(found) // PASSAGE))
    for k in range(0, n, BLOCK):
        at = range(k, min(n, k + BLOCK))
        parts = found[at[0] * PASSAGE : (at[-1] + 1) * PASSAGE]
        code = np.fromiter(map(codes.__getitem__, parts), np.int64, len(parts))
        row = np.arange(len(parts)) // PASSAGE * FEATURES
        total = np.bincount(row + (code & 255), minlength=len(at) * FEATURES) + np.bincount(row + WORD_SLOTS + ((code >> 8) & 255), minlength=len(at) * FEATURES)
        total = total[: len(at) * FEATURES].reshape(len(at), FEATURES).astype(np.float32)
        size = np.bincount(row // FEATURES, minlength=len(at)).astype(np.float32)
        out = np.sqrt(total / np.maximum(size, 1)[:, None])
        same = np.r_[False, code[1:] == code[:-1]] if len(code) else np.zeros(0, bool)
        same[::PASSAGE] = False  # only within a passage
        at_row = row // FEATURES
        mean = lambda x: np.bincount(at_row, x, len(at)) / np.maximum(size, 1)
        length = (code >> 16) & 255
        out[:, WORD_SLOTS + SHAPE_SLOTS :] = np.stack([mean(same), mean(length) / 10, np.sqrt(mean(length**2)) / 10, size / PASSAGE, size == 0, mean(length <= 2), mean(length >= 20), np.ones(len(at))], 1)
        yield out


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    g = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
    return {"W": g(FEATURES, HIDDEN), "V": g(HIDDEN, GATES), "U": g(HIDDEN, GATES), "a": g(GATES, 1)[:, 0], "c": g(HIDDEN, 1)[:, 0], "b": np.zeros(1, np.float32)}


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def attend(hidden: np.ndarray, starts: np.ndarray, m: dict) -> tuple[np.ndarray, ...]:
    """Gated attention over the passages of each bag; returns the gates' parts, the weights and the bags' representations."""
    left, right = np.tanh(hidden @ m["V"]), _sigmoid(hidden @ m["U"])
    logit = (left * right) @ m["a"]
    sizes = np.diff(np.r_[starts, len(hidden)])
    weight = np.exp(logit - np.repeat(np.maximum.reduceat(logit, starts), sizes))
    weight /= np.repeat(np.add.reduceat(weight, starts), sizes)
    return left, right, weight, np.add.reduceat(weight[:, None] * hidden, starts), sizes


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 17) -> dict[str, np.ndarray]:
    """Learns all layers from bag labels, both labels weighing the same."""
    rng = np.random.default_rng(seed)
    m = _start(rng)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    share, step = labels.mean(), 0
    cost = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for k in range(0, len(order), BATCH):
            pick = order[k : k + BATCH]
            x = np.concatenate([bags[i] for i in pick]).astype(np.float32)
            starts = np.cumsum([0, *(len(bags[i]) for i in pick[:-1])])
            hidden = np.tanh(x @ m["W"])
            left, right, weight, bag, sizes = attend(hidden, starts, m)
            off = (_sigmoid(bag @ m["c"] + m["b"]) - labels[pick]) * cost[pick] / len(pick)
            d_bag = np.repeat(off[:, None] * m["c"], sizes, 0)
            d_weight = (d_bag * hidden).sum(1)
            d_logit = weight * (d_weight - np.repeat(np.add.reduceat(weight * d_weight, starts), sizes))
            d_gate = d_logit[:, None] * m["a"]
            d_left, d_right = d_gate * right * (1 - left**2), d_gate * left * right * (1 - right)
            d_hidden = weight[:, None] * d_bag + d_left @ m["V"].T + d_right @ m["U"].T
            grads = {"W": x.T @ (d_hidden * (1 - hidden**2)), "V": hidden.T @ d_left, "U": hidden.T @ d_right, "a": (left * right).T @ d_logit, "c": bag.T @ off, "b": off.sum(keepdims=True)}
            step += 1
            for name, g in grads.items():
                g = g.astype(np.float32) + 1e-5 * m[name]
                first, second = moments[name]
                first += 0.1 * (g - first)
                second += 0.001 * (g * g - second)
                m[name] -= RATE * (1 - 0.9 * epoch / EPOCHS) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return m


def score(texts, m: dict | float) -> np.ndarray:
    """The probability of label 1 for each text."""
    if isinstance(m, float):
        return np.array([m for _ in texts])
    codes, out = Codes(), []
    waiting, sizes = [], []

    def flush():
        if sizes:
            hidden = np.concatenate(waiting)
            bag = attend(hidden, np.cumsum([0, *sizes[:-1]]), m)[3]
            out.append(_sigmoid(bag @ m["c"] + m["b"]))
            waiting.clear()
            sizes.clear()

    raw, held = [], 0
    for text in texts:
        n = 0
        for block in encode(text, codes):
            raw.append(block)
            n += len(block)
            held += len(block)
            if held >= BLOCK:
                waiting.append(np.tanh(np.concatenate(raw) @ m["W"]))
                raw, held = [], 0
        sizes.append(n)
        if sum(map(len, waiting)) >= BLOCK or len(sizes) >= 512:
            if raw:
                waiting.append(np.tanh(np.concatenate(raw) @ m["W"]))
                raw, held = [], 0
            flush()
    if raw:
        waiting.append(np.tanh(np.concatenate(raw) @ m["W"]))
    flush()
    return np.concatenate(out) if out else np.zeros(0)


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, passages: int = SAMPLE_PASSAGES) -> DataFrame:
    """doc_id, text and label of at most size different documents whose remainder modulo 3 is not 1, which have about that many
    passages at most (the first of either label is always taken). Broadcast and collected rows are bounded by size."""
    spark = docs.sparkSession
    votes = labels.filter("quality is not null and doc_id is not null").filter(remainder(F.col("doc_id"), 3) != 1)
    votes = votes.groupBy("doc_id").agg(F.avg("quality").alias("mean")).filter("mean <> 0.5").select("doc_id", (F.col("mean") > 0.5).cast("int").alias("label"))
    half = [votes.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size // 2) for k in (0, 1)]
    labelled = docs.select("doc_id", "text", F.xxhash64("text").alias("digest")).join(F.broadcast(half[0].unionByName(half[1])), "doc_id")
    small = labelled.select("doc_id", "digest", "label", F.size(words(F.col("text"))).alias("n")).distinct()
    picked = []
    for k in (0, 1):
        total = 0
        for r in small.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id", "digest").limit(size // 2).collect():
            total += max(1, -(-r.n // PASSAGE))
            if total > passages // 2 and r.n and any(x[2] == k for x in picked):
                break
            picked.append((r.doc_id, r.digest, k))
    picked = spark.createDataFrame(picked, "doc_id long, digest long, label int")
    chosen = labelled.drop("label").join(F.broadcast(picked), ["doc_id", "digest"])
    return chosen.groupBy("doc_id", "digest").agg(F.first("text").alias("text"), F.first("label").alias("label"))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes = Codes()
    for batch in batches:
        bags = [np.concatenate(list(encode(t.as_py(), codes))).astype(np.float16).tobytes() for t in batch.column("text")]
        yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "digest", "label")), pa.array(bags, pa.binary())], ["doc_id", "digest", "label", "bag"])


def learn(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> dict[str, np.ndarray] | float:
    """The model, or one score for all where the sample holds no two labels."""
    rows = labelled_sample(docs, labels, size).select("doc_id", "digest", "label", "text").mapInArrow(_features, "doc_id long, digest long, label int, bag binary").toArrow()
    order = np.lexsort((rows.column("digest").to_numpy(), rows.column("doc_id").to_numpy()))
    bags = [np.frombuffer(rows.column("bag")[i].as_py(), np.float16).reshape(-1, FEATURES) for i in order.tolist()]
    target = rows.column("label").to_numpy()[order].astype(np.float32)
    if len(set(target.tolist())) < 2:
        return float(target.mean()) if len(target) else 0.5
    return fit(bags, target)


def with_score(docs: DataFrame, model, text: str = "text", name: str = "score") -> DataFrame:
    shared = Shared(docs.sparkSession, model)

    @F.arrow_udf(T.DoubleType())
    def of(column: pa.Array) -> pa.Array:
        return pa.array(score((x.as_py() for x in column), shared.value).astype(np.float64))

    return docs.withColumn(name, of(F.col(f"`{text}`")))


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = with_score(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs with a score of 0.5 or more, with the columns of docs."""
    name = free_name(docs, "quality_score")
    return with_score(docs, learn(docs, labels), name=name).filter(F.col(name) >= 0.5).select(*(F.col(f"`{c}`") for c in docs.columns))


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
