"""Language-model scoring: a log-bilinear model trained with noise-contrastive estimation, and an add-one unigram base.

Counts. Tokens are the words of a text, A-Z in lower case, and one end. Texts are read once: every task writes them as blocks of
numbers with the block's own dictionary, which counts its training tokens (words stand as their XXH64; two words that share one of
2**64 values count as one). Dictionaries are summed in a shuffle. The HEAD most frequent words, a bounded table, and the end reach
every task; other words go through a join of their keys with the counts, where no key can be hot. So counts cover the whole corpus
at any size, and nothing of unbounded size is broadcast or collected.

Model. The SINGLES most frequent words are classes of their own, all others share BUCKETS classes by their last letters. The
vectors of the two classes before a token, each through a matrix of its place, add up to a prediction; its product with the
class's vector, plus a bias, is the class's logit. Within a shared class every head word seen WORD_SEEN times or more has a vector
of its own, and so has the rest of the class; they are told apart by the vector of the class before through one more matrix. The
rest's words take their add-one share of its counts, so all words, with one mass for unseen words per shared class, add up to one.
As logits are sums, the class sums of all pairs of classes before are one matrix product, exp(first) @ exp(second), and the word
sums of all classes one more: every token's log-probability is exactly normalised without a softmax of its own.

Training contrasts true classes and words with noise drawn from their frequencies. It begins with at most BURN_IN tokens in one
task; from there every task goes over all its training texts, and each row of the parameters is averaged over the tasks by how
often it was trained there. Parameters travel and are added up in slices; the driver gets their sums alone.

Edge cases: a null or empty text is the end alone; without training documents all counts are zero and the model predicts from
its start values; repeated rows are scored each; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm.common import Shared, drop_written, remainder, written

HEAD = 150_000
SINGLES, BUCKETS = 1024, 128  # buckets are stored as bytes; class 0 is the end, which also stands before a text
CLASSES = SINGLES + BUCKETS
WORD_SEEN = 20
WIDTH = 16
BATCH, NOISE, WORD_NOISE = 2048, 64, 2
RATE, WORD_RATE = 0.04, 0.3
BURN_IN = 1_000_000
#: Tokens of a block, the last text's apart.
BLOCK = 1 << 17
#: Tokens that a training task shuffles at once.
HELD = 1 << 18
#: Bytes of blocks that a task reads or writes at once.
ROW_GROUP = 2 << 20
#: Rows of parameters that travel together.
SLICE = 8192
#: Parts in which equal slices are first added up.
PARTS = 64
END = 0  # the end's key


def key_of(word: bytes) -> int:
    """XXH64 as a signed long; never END."""
    h = xxhash.xxh64_intdigest(word)
    return (h - (1 << 64) if h >> 63 else h) or 1


def bucket_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word[-2:], 3) % BUCKETS


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


BLOCKS = "rows binary, ids binary, id_null binary, train binary, sizes binary, numbers binary, keys binary, buckets binary, counts binary"


def _number_type(n: int) -> type:
    """What holds a block's numbers of n keys."""
    return np.uint16 if n <= 1 << 16 else np.int32


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole texts: their row numbers, ids, sizes and training marks, their tokens as numbers (0: the end), and what
    these numbers stand for with their counts in training texts."""
    class Numbers(dict):
        def __missing__(self, word: bytes) -> int:
            self[word] = n = len(keys)
            keys.append(key_of(word))
            buckets.append(bucket_of(word))
            return n

    def block():
        sizes = np.array([len(x) for x in held])
        flat = np.concatenate(held)
        train = np.array([r[2] for r in rows], bool)
        counts = np.bincount(flat[np.repeat(train, sizes)], minlength=len(keys))
        ids = [r[1] for r in rows]
        flat = flat.astype(_number_type(len(keys)))
        parts = [np.array([r[0] for r in rows], np.int64), np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], bool), train, sizes.astype(np.int64), flat, np.array(keys, np.int64), np.array(buckets, np.uint8), counts.astype(np.int32)]
        return pa.record_batch([pa.array([x.tobytes()], pa.binary()) for x in parts], [x.split()[0] for x in BLOCKS.split(", ")])

    keys, buckets, numbers, rows, held, size = [END], [0], Numbers(), [], [], 0
    for batch in batches:
        for number, i, train, text in zip(*batch.columns, strict=True):
            found = tokens(text.as_py())
            out = np.zeros(len(found) + 1, np.int32)
            out[:-1] = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
            rows.append((number.as_py(), i.as_py(), train.as_py()))
            held.append(out)
            size += len(out)
            if size >= BLOCK:
                yield block()
                numbers.clear()
                del keys[1:], buckets[1:]
                rows, held, size = [], [], 0
    if rows:
        yield block()


def text_blocks(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text. The whole table as blocks; the rest of the operator reads no text."""
    number = F.monotonically_increasing_id()
    return written(docs.select(number, "doc_id", remainder(F.col("doc_id"), 7) != 2, "text").mapInArrow(_blocks, BLOCKS), "text-blocks", ROW_GROUP)


def _dictionaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            keys, buckets, counts = (np.frombuffer(x.as_py(), t) for x, t in zip(row, (np.int64, np.uint8, np.int32), strict=True))
            some = np.flatnonzero(counts)
            yield pa.record_batch([pa.array(keys[some]), pa.array(buckets[some].astype(np.int32)), pa.array(counts[some].astype(np.int64))], ["key", "bucket", "n"])


def corpus_counts(blocks: DataFrame) -> DataFrame:
    """key, bucket and n of every token type of the training texts."""
    single = blocks.select("keys", "buckets", "counts").mapInArrow(_dictionaries, "key long, bucket int, n long")
    return written(single.groupBy("key").agg(F.first("bucket").alias("bucket"), F.sum("n").alias("n")), "token-counts")


class Vocabulary:
    """The head's keys and counts, and what each number stands for: 0 the end, then the head by frequency, then the buckets.
    `kind` is a number's class, `row` its word vector (-1: a class of its own). Totals are those of the whole corpus."""

    def __init__(self, counts: DataFrame):
        step = F.floor(F.log2("n") * 8)
        totals = counts.groupBy(step.alias("step")).agg(F.count("*").alias("types"), F.sum("n").alias("n"), F.min("n").alias("least")).collect()
        self.types, self.tokens = sum(r.types for r in totals), sum(r.n for r in totals)
        least, taken = None, 0
        for r in sorted(totals, key=lambda r: -r.step):
            taken += r.types
            if taken > HEAD:
                break
            least = r.least
        head = counts.filter((F.col("n") >= least) if least is not None else F.lit(False)).filter(F.col("key") != END).toArrow()
        keys, n, buckets = (head.column(c).to_numpy() for c in ("key", "n", "bucket"))
        order = np.lexsort((keys, -n))
        keys, n, buckets = keys[order], n[order], buckets[order]
        ends = sum(r.n for r in counts.filter(F.col("key") == END).collect())  # exact, whether the head reaches it or not
        by_key = np.argsort(keys)
        self.keys, self.numbers = keys[by_key], (by_key + 1).astype(np.int32)
        self.size = len(keys) + 1
        single = min(len(keys), SINGLES - 1)
        self.kind = np.r_[np.arange(single + 1), SINGLES + buckets[single:], SINGLES + np.arange(BUCKETS)].astype(np.int32)
        self.log = np.log10(np.r_[ends, n, np.zeros(BUCKETS)] + 1.0)
        self.log[self.size :] = 0

        shared = np.zeros((BUCKETS, 2))  # tokens and types of each bucket, less the single words'
        for r in counts.filter(F.col("key") != END).groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():
            shared[r.bucket] = r.n, r.types
        np.subtract.at(shared, buckets[:single], np.stack([n[:single], np.ones(single)], 1))
        self.share = np.zeros(CLASSES) + 0.1
        self.share[: single + 1] += np.r_[ends, n[:single]]
        self.share[SINGLES:] += shared[:, 0]

        own = single + np.flatnonzero(n[single:] >= WORD_SEEN)
        own = own[np.argsort(buckets[own], kind="stable")]
        np.subtract.at(shared, buckets[own], np.stack([n[own], np.ones(len(own))], 1))
        self.rest_log = np.log10(shared.sum(1) + 1)  # what the rest's counts divide by
        self.first = np.searchsorted(buckets[own], np.arange(BUCKETS)) + np.arange(BUCKETS)  # of each bucket's rows
        rest = np.r_[self.first[1:], len(own) + BUCKETS] - 1
        self.row = np.full(self.size + BUCKETS, -1, np.int32)
        self.row[single + 1 :] = rest[self.kind[single + 1 :] - SINGLES]
        self.row[own + 1] = np.arange(len(own)) + buckets[own]
        self.rest = np.r_[np.zeros(single + 1, bool), np.ones(self.size + BUCKETS - single - 1, bool)]
        self.rest[own + 1] = False
        self.word_share = np.zeros(len(own) + BUCKETS)
        self.word_share[self.row[own + 1]] = n[own]
        self.word_share[rest] = shared[:, 0] + 0.1


    def of(self, keys: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """The numbers of words by key and bucket."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out = np.where(known, self.numbers[at] if len(self.keys) else 0, self.size + buckets.astype(np.int32))
        return np.where(keys == END, np.int32(0), out)

    def texts(self, numbers: bytes, keys: bytes, buckets: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A block's tokens as the vocabulary's numbers, and as its own with what keys these have."""
        keys = np.frombuffer(keys, np.int64)
        own = np.frombuffer(numbers, _number_type(len(keys)))
        return self.of(keys, np.frombuffer(buckets, np.uint8))[own], own, keys


Model = dict[str, np.ndarray]


def new_model(vocabulary: Vocabulary, seed: int = 5) -> Model:
    """R: classes as context; C: matrices of the two places; Q: classes as predicted, with a bias in the last column; S, W: the
    same for words within a class."""
    rng = np.random.default_rng(seed)
    g = lambda n: rng.standard_normal((n, WIDTH)) * 0.1
    share, words = vocabulary.share, vocabulary.word_share
    within = words / np.repeat(np.add.reduceat(words, vocabulary.first), np.diff(np.r_[vocabulary.first, len(words)]))
    eye = np.eye(WIDTH) * 0.5
    model = {"R": g(CLASSES), "C": np.stack([eye, eye]), "Q": np.c_[g(CLASSES), np.log(share / share.sum())], "S": eye, "W": np.c_[g(len(words)), np.log(within)]}
    return {k: v.astype(np.float32) for k, v in model.items()}


def contexts(classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For the tokens of concatenated texts that begin at starts: the two classes before each, latest first; 0 before a text."""
    out = np.zeros((len(classes), 2), classes.dtype)
    out[1:, 0], out[2:, 1] = classes[:-1], classes[:-2]
    out[starts, :] = 0
    second = starts + 1
    out[second[second < len(classes)], 1] = 0
    return out


def _gathered(places: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of values by their places, of which there are n."""
    width = values.shape[1]
    flat = (places[:, None] * width + np.arange(width)).ravel()
    return np.bincount(flat, values.ravel(), n * width).reshape(n, width).astype(np.float32)


def _excess(score: np.ndarray) -> np.ndarray:
    """The logistic function, in place; a score beyond the range of exp gives 0."""
    np.negative(score, out=score)
    with np.errstate(over="ignore"):
        np.exp(score, out=score)
    score += 1
    return np.reciprocal(score, out=score)


class Trainer:
    """Noise-contrastive estimation on texts as numbers; a batch shares its noise classes, so both sides are matrix products."""

    def __init__(self, model: Model, vocabulary: Vocabulary, seed: int = 5):
        self.m = {k: v.copy() for k, v in model.items()}
        self.v, self.rng = vocabulary, np.random.default_rng(seed)
        noise = vocabulary.share / vocabulary.share.sum()
        self.offset, self.cdf = np.log(noise * NOISE).astype(np.float32), np.cumsum(noise)
        words, first = vocabulary.word_share, vocabulary.first
        ends = np.r_[0, np.cumsum(words)]
        self.words, self.lows, self.highs = ends[1:], ends[first], ends[np.r_[first[1:], len(words)]]
        within = words / np.repeat(self.highs - self.lows, np.diff(np.r_[first, len(words)]))
        self.word_offset = np.log(within * WORD_NOISE).astype(np.float32)
        self.squares = {k: np.full_like(v, 1e-6) for k, v in self.m.items()}
        self.trained = {k: np.zeros(len(self.m[k])) for k in ("R", "Q", "W")}
        self.tokens = 0

    def epoch(self, numbers: np.ndarray, sizes: np.ndarray, first: float, last: float) -> None:
        """Goes once over all tokens of concatenated texts of these sizes; the rates fall from their share first to last."""
        v = self.v
        target = v.kind[numbers]
        before, row = contexts(target, np.cumsum(sizes) - sizes), v.row[numbers]
        order = self.rng.permutation(len(numbers))
        for k in range(0, len(order), BATCH):
            pick = order[k : k + BATCH]
            self.step(target[pick], before[pick], row[pick], first + (last - first) * k / len(order))
        self.tokens += len(numbers)
        self.trained["Q"] += np.bincount(target, minlength=CLASSES)
        self.trained["R"] += np.bincount(before[:, 0], minlength=CLASSES)
        self.trained["W"] += np.bincount(row[row >= 0], minlength=len(self.m["W"]))

    def step(self, w: np.ndarray, h: np.ndarray, row: np.ndarray, share: float) -> None:
        m, rng = self.m, self.rng
        false = np.minimum(np.searchsorted(self.cdf, rng.random(NOISE)), CLASSES - 1)
        first, second = m["R"][h[:, 0]], m["R"][h[:, 1]]
        guess = np.ones((len(w), WIDTH + 1), np.float32)
        guess[:, :WIDTH] = first @ m["C"][0] + second @ m["C"][1]
        true_q, false_q = m["Q"][w], m["Q"][false]
        d_true = _excess(np.einsum("nd,nd->n", guess, true_q) - self.offset[w]) - 1
        d_false = _excess(guess @ false_q.T - self.offset[false])
        d_guess = (d_true[:, None] * true_q + d_false @ false_q)[:, :WIDTH]
        d_past = np.empty((2, len(w), WIDTH), np.float32)
        np.matmul(d_guess, m["C"][0].T, out=d_past[0])
        np.matmul(d_guess, m["C"][1].T, out=d_past[1])
        q = _gathered(w, d_true[:, None] * guess, CLASSES)
        np.add.at(q, false, d_false.T @ guess)
        grads = {"C": np.stack([first.T @ d_guess, second.T @ d_guess]), "Q": q}
        inside = np.flatnonzero(row >= 0)
        if len(inside):
            bucket = w[inside] - SINGLES
            low, high, least = self.lows[bucket], self.highs[bucket], self.v.first[bucket]
            some = np.empty((1 + WORD_NOISE, len(inside)), np.int64)
            some[0] = row[inside]
            for k in range(1, 1 + WORD_NOISE):
                some[k] = np.minimum(np.maximum(np.searchsorted(self.words, low + rng.random(len(inside)) * (high - low), "right"), least), len(self.words) - 1)
            near = first[inside]
            guess = np.ones((len(inside), WIDTH + 1), np.float32)
            guess[:, :WIDTH] = near @ m["S"]
            vectors = m["W"][some]
            d = _excess(np.einsum("md,kmd->km", guess, vectors) - self.word_offset[some])
            d[0] -= 1
            d_near = np.einsum("km,kmd->md", d, vectors[:, :, :WIDTH])
            grads["S"] = near.T @ d_near
            d_past[0, inside] += d_near @ m["S"].T
            rows, at = np.unique(some, return_inverse=True)
            g = _gathered(at.ravel(), (d[:, :, None] * guess).reshape(-1, WIDTH + 1), len(rows))
            squares = self.squares["W"][rows] + g * g
            self.squares["W"][rows] = squares
            m["W"][rows] -= WORD_RATE * share * g / np.sqrt(squares + 1e-2)
        grads["R"] = _gathered(h.T.ravel(), d_past.reshape(-1, WIDTH), CLASSES)
        for x, g in grads.items():
            g /= len(w)
            self.squares[x] *= 0.99
            self.squares[x] += 0.01 * g * g
            m[x] -= RATE * share * g / (np.sqrt(self.squares[x]) + 1e-4)


def _packed(m: Model) -> np.ndarray:
    """All parameters as rows of equal width."""
    wide = WIDTH + 1
    return np.concatenate([np.c_[m["R"], np.zeros(CLASSES, np.float32)], m["Q"], m["W"], np.pad(np.concatenate([m["C"].reshape(-1, WIDTH), m["S"]]), ((0, 0), (0, wide - WIDTH)))])


def _unpacked(rows: np.ndarray) -> Model:
    r, q, c = CLASSES, 2 * CLASSES, len(rows) - 3 * WIDTH
    return {"R": rows[:r, :WIDTH].copy(), "Q": rows[r:q], "W": rows[q:c], "C": rows[c : c + 2 * WIDTH, :WIDTH].reshape(2, WIDTH, WIDTH).copy(), "S": rows[c + 2 * WIDTH :, :WIDTH].copy()}


SUMS = "slice int, weights binary, sums binary"


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up equal slices; rows come sorted by slice, and one slice is held at a time."""
    def out():
        return pa.record_batch([pa.array([now], pa.int32()), pa.array([weights.tobytes()], pa.binary()), pa.array([sums.tobytes()], pa.binary())], ["slice", "weights", "sums"])

    now = None
    for batch in batches:
        for i, w, s in zip(*batch.columns, strict=True):
            w, s = np.frombuffer(w.as_py()), np.frombuffer(s.as_py(), np.float32)
            if i.as_py() == now:
                weights, sums = weights + w, sums + s
            else:
                if now is not None:
                    yield out()
                now, weights, sums = i.as_py(), w, s
    if now is not None:
        yield out()


def train(blocks: DataFrame, model: Model, vocabulary: Vocabulary, first: float, last: float, share: float = 1.0) -> Model:
    """One round over the training texts of all blocks, in their tasks; share: over that part of the texts, by their row numbers."""
    start = Shared(blocks.sparkSession, (model, vocabulary))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, begin, held = None, first, []

        def go(share):
            nonlocal trainer, begin
            numbers, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
            trainer = trainer or Trainer(*start.value, xxhash.xxh64_intdigest(sizes.tobytes()))
            trainer.epoch(numbers, sizes, begin, begin + (last - begin) * share)
            begin += (last - begin) * share
            held.clear()

        for batch in batches:
            for numbers, keys, buckets, train, sizes, rows in zip(*batch.columns, strict=True):
                train, sizes, rows = np.frombuffer(train.as_py(), bool), np.frombuffer(sizes.as_py(), np.int64), np.frombuffer(rows.as_py(), np.uint64)
                if share < 1:
                    train = train & ((rows * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(34)) < share * (1 << 30))
                if train.any():
                    flat = start.value[1].texts(numbers.as_py(), keys.as_py(), buckets.as_py())[0]
                    held.append((flat[np.repeat(train, sizes)], sizes[train]))
                    if sum(len(x) for x, _ in held) >= HELD:
                        go(0.25)
        if held:
            go(1)
        if trainer:
            weights = np.concatenate([trainer.trained["R"], trainer.trained["Q"], trainer.trained["W"], np.full(3 * WIDTH, float(trainer.tokens))])
            sums = (_packed(trainer.m) * weights[:, None]).astype(np.float32)
            for k in range(0, len(sums), SLICE):
                yield pa.record_batch([pa.array([k // SLICE], pa.int32()), pa.array([weights[k : k + SLICE].tobytes()], pa.binary()), pa.array([sums[k : k + SLICE].tobytes()], pa.binary())], ["slice", "weights", "sums"])

    sums = blocks.select("numbers", "keys", "buckets", "train", "sizes", "rows").mapInArrow(fit, SUMS)
    for keys in (["slice", F.pmod(F.xxhash64("weights", "sums"), F.lit(PARTS))], ["slice"]):  # in two steps, so that no task adds up a slice of all
        sums = sums.repartition(*keys).sortWithinPartitions("slice").mapInArrow(_added, SUMS)
    merged = {r.slice: r for r in sums.collect()}
    if not merged:
        return model
    weights = np.concatenate([np.frombuffer(bytes(merged[k].weights)) for k in sorted(merged)])
    total = np.concatenate([np.frombuffer(bytes(merged[k].sums), np.float32) for k in sorted(merged)]).reshape(-1, WIDTH + 1)
    before = _packed(model)
    return _unpacked(np.where(weights[:, None] > 0, total / np.maximum(weights, 1)[:, None], before).astype(np.float32))


def train_on_all(blocks: DataFrame, vocabulary: Vocabulary) -> Model:
    """The first steps take BURN_IN training tokens or so, the round after them every training text."""
    share = BURN_IN / max(1, vocabulary.tokens)
    few = blocks if share >= 1 else blocks.filter(F.pmod(F.xxhash64("rows"), F.lit(1 << 30)) / float(1 << 30) < share * 4)
    model = train(few.repartition(1), new_model(vocabulary), vocabulary, 1.0, 0.3, 1.0 if share >= 1 else 0.25)
    return train(blocks, model, vocabulary, 0.5, 0.05)


class Scorer:
    """The model's normalised log-probabilities (base 10) of texts as numbers."""

    def __init__(self, vocabulary: Vocabulary, m: Model):
        self.vocabulary, self.q, self.w = vocabulary, m["Q"], m["W"]
        one = np.ones((CLASSES, 1), np.float32)
        self.first, self.second = np.hstack([m["R"] @ m["C"][0], one]), np.hstack([m["R"] @ m["C"][1], one * 0])
        self.near = np.hstack([m["R"] @ m["S"], one])
        logit = [x.astype(np.float64) @ m["Q"].T.astype(np.float64) for x in (self.first, self.second)]
        top = [x.max(1) for x in logit]
        self.sums = (np.log(np.exp(logit[0] - top[0][:, None]) @ np.exp(logit[1] - top[1][:, None]).T) + top[0][:, None] + top[1]).astype(np.float32)
        self.word_sums = np.empty((CLASSES, BUCKETS), np.float32)
        sizes = np.diff(np.r_[vocabulary.first, len(self.w)])
        for k in range(0, CLASSES, 32):
            x = self.near[k : k + 32] @ self.w.T
            high = np.maximum.reduceat(x, vocabulary.first, 1)
            self.word_sums[k : k + 32] = np.log(np.add.reduceat(np.exp(x - np.repeat(high, sizes, 1)), vocabulary.first, 1)) + high

    def class_logs(self, before: np.ndarray, target: np.ndarray) -> np.ndarray:
        a, b = before[:, 0], before[:, 1]
        return np.einsum("nd,nd->n", self.first[a] + self.second[b], self.q[target]) - self.sums[a, b]

    def word_logs(self, before: np.ndarray, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return np.einsum("nd,nd->n", self.near[before], self.w[row]) - self.word_sums[before, bucket]

    def __call__(self, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each of concatenated texts: known head tokens, the head's sum of log10(count + 1), and the log10 probability but for the
        log10(count + 1) of words outside the head."""
        v = self.vocabulary
        starts = np.cumsum(sizes) - sizes
        kind, row, log = v.kind[numbers], v.row[numbers], v.log[numbers]
        before = contexts(kind, starts)
        model = self.class_logs(before, kind).astype(np.float64)
        inside = np.flatnonzero(row >= 0)
        model[inside] += self.word_logs(before[inside, 0], row[inside], kind[inside] - SINGLES)
        model /= np.log(10)
        rest = np.flatnonzero(v.rest[numbers])
        model[rest] += log[rest] - v.rest_log[kind[rest] - SINGLES]
        return np.add.reduceat((log > 0).astype(np.int64), starts), np.add.reduceat(log, starts), np.add.reduceat(model, starts)


FIRST = "row_number long, doc_id long, n_tokens long, n_head long, head_log double, model_log double, tail array<long>"


def scored_documents(docs: DataFrame) -> DataFrame:
    blocks = text_blocks(docs.select("doc_id", "text"))
    counts = corpus_counts(blocks)
    vocabulary = Vocabulary(counts)
    shared = Shared(docs.sparkSession, Scorer(vocabulary, train_on_all(blocks, vocabulary)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, ids, null, sizes, numbers, keys, buckets in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                scorer, sizes = shared.value, np.frombuffer(sizes, np.int64)
                flat, own, keys = scorer.vocabulary.texts(numbers, keys, buckets)
                known, head, model = scorer(flat, sizes)
                outside = flat >= scorer.vocabulary.size
                ends = np.r_[0, np.cumsum(outside)][np.r_[0, np.cumsum(sizes)]]
                tail = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[own[outside]]))
                ids = pa.array(np.frombuffer(ids, np.int64), mask=np.frombuffer(null, bool))
                yield pa.record_batch([pa.array(np.frombuffer(rows, np.int64)), ids, pa.array(sizes), pa.array(known), pa.array(head), pa.array(model), tail], [x.split()[0] for x in FIRST.split(", ")])

    first = written(blocks.select("rows", "ids", "id_null", "sizes", "numbers", "keys", "buckets").mapInArrow(score, FIRST), "first-scores")
    drop_written(blocks)
    tail = first.select("row_number", F.explode("tail").alias("key")).join(counts.select("key", "n"), "key")
    tail = tail.groupBy("row_number").agg(F.sum(F.log10(F.col("n") + 1)).alias("tail_log"), F.count("*").alias("n_tail"))
    both = first.drop("tail").join(tail, "row_number", "left")
    more, n = F.coalesce("tail_log", F.lit(0.0)), F.lit(vocabulary.tokens).cast("long")
    return both.select(
        "doc_id",
        (remainder(F.col("doc_id"), 7) == 2).alias("held_out"),
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"),
        n.alias("train_tokens"),
        (F.col("head_log") + more - F.col("n_tokens") * F.log10(n + F.lit(vocabulary.types + 1))).alias("base_score"),
        (F.col("model_log") + more).alias("score"),
    )
