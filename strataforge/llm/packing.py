"""Best-fit decreasing packing into several permitted sequence lengths.

A document's tokens are its white-space words and one end. Documents above the largest length are cut into pieces of that
length. Pieces are packed in order of decreasing length, each into the open bin with the least room that holds it (of several
the one opened first). Where none
does, the bin size with the least cost per token that it can come to hold opens (a bin has a fixed cost, a cost per slot and one
that grows with the square, so the sizes compete; what is left to pack counts). In the end every bin shrinks to the smallest
permitted length that holds its contents.

The packing is that of the whole corpus, not of partitions: it only depends on how many pieces of each length there are, a table
with as many rows as the largest length has tokens at most. The driver packs that table, equal bins at once, and what comes out
is a short plan: which ranks among the pieces of a length go to which range of bins. Pieces get their ranks by a window over
(length, salt) and the counts of smaller salts, and look up their bin. The salt comes from the row's number, and a length has as many
salts as its pieces fill windows of RANKED, so neither a length that a third of all pieces share (as all whole pieces of cut
documents do) nor an id that repeats makes a large group at any size.

Edge cases: a null or empty text is the end token alone; repeated rows are packed each; null doc_ids are packed as well; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.common import Shared, written

SIZES = (256, 512, 1024, 2048, 4096)
#: Pieces that a window ranks, or about so.
RANKED = 500
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Bytes of piece texts that a batch holds.
BATCH = 16 << 20


def cost(size: int) -> float:
    """Of running a sequence: fixed, linear and quadratic (attention) parts, in tokens."""
    return 64 + size + size * size / 65536


class Plan:
    """segments: (length, first rank, pieces, first bin, pieces a bin, offset in the bin); bins: (first bin, tokens, size)."""

    def __init__(self, segments: list[tuple], bins: list[tuple]):
        segments, bins = sorted(segments), sorted(bins)
        self.segments = np.array(segments, np.int64).reshape(-1, 6)
        self.key = (self.segments[:, 0] << 44) | self.segments[:, 1]
        self.bins = np.array(bins, np.int64).reshape(-1, 3)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """Bin, offset and size for pieces by length and rank (from 0)."""
        s = self.segments[np.searchsorted(self.key, (length << 44) | rank, "right") - 1]
        nth = rank - s[:, 1]
        number = s[:, 3] + nth // s[:, 4]
        return number, s[:, 5] + nth % s[:, 4] * length, self.bins[np.searchsorted(self.bins[:, 0], number, "right") - 1, 2]


def pack(counts: dict[int, int], sizes: Sequence[int] = SIZES, price: Callable[[int], float] = cost) -> Plan:
    """Best-fit decreasing over numbers of pieces by length; the same bins as piece by piece."""
    sizes = sorted(sizes)
    if counts and max(counts) > sizes[-1]:
        raise ValueError("a piece is longer than the largest size")
    smaller, total = {}, 0  # tokens of pieces up to each length
    lengths = sorted(counts)
    for n in lengths:
        total += n * counts[n]
        smaller[n] = total

    def tokens_up_to(n: int) -> int:
        k = bisect_left(lengths, n + 1)
        return smaller[lengths[k - 1]] if k else 0

    def opened(n: int, left: int) -> int:
        """The size to open for a piece of length n, left of which (this one too) are not packed yet."""
        def rate(size: int) -> tuple[float, int]:
            room = size - n
            others = tokens_up_to(min(room, n - 1)) + (n * (left - 1) if room >= n else 0)
            filled = n + min(room, others)
            return price(sizes[bisect_left(sizes, filled)]) / filled, size
        return min((s for s in sizes if s >= n), key=rate)

    rooms: list[int] = []  # sorted; of open bins
    open_bins: dict[int, list[tuple[int, int, int]]] = {}  # room -> (first bin, bins, size)
    segments, next_bin = [], 0

    def add(room: int, entry: tuple[int, int, int]) -> None:
        if room not in open_bins:
            insort(rooms, room)
            open_bins[room] = []
        insort(open_bins[room], entry)

    for n in reversed(lengths):
        left = counts[n]
        while left:
            k = bisect_left(rooms, n)
            if k == len(rooms):
                size = opened(n, left)
                each = size // n
                if left >= each and opened(n, each) != size:  # the last of this length may open another size
                    bins = max(1, left // each - 1)
                else:
                    bins = max(1, left // each)
                if bins > 1:
                    bins = _same_choice(bins, each, left, lambda x: opened(n, x) == size)
                first, room = next_bin, size
                next_bin += bins
            else:
                room = rooms[k]
                first, bins, size = open_bins[room].pop(0)
                if not open_bins[room]:
                    del open_bins[room], rooms[k]
                each = room // n
            used = min(bins, max(1, left // each))
            held = min(each, left)
            segments.append((n, counts[n] - left, used * held, first, held, size - room))
            left -= used * held
            add(room - held * n, (first, used, size))
            if used < bins:
                add(room, (first + used, bins - used, size))
    bins = [(first, size - room, sizes[bisect_left(sizes, size - room)]) for room, entries in open_bins.items() for first, n, size in entries]
    return Plan(segments, bins)


def _same_choice(bins: int, each: int, left: int, holds: Callable[[int], bool]) -> int:
    """How many bins in a row would be opened with the same choice: the choice only turns once as pieces run out."""
    lo, hi = 1, bins
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if holds(left - (mid - 1) * each):
            lo = mid
        else:
            hi = mid - 1
    return lo


def _cut(most: int, texts: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                n = len(data.split()) + 1
                if n <= most:
                    out.append((i, 0, 0, n, data if texts else None))
                else:
                    starts = [m.start() for m in WORD.finditer(data)] if texts else None
                    for k, at in enumerate(range(0, n, most)):
                        piece = data[starts[at] if 0 < at < n - 1 else len(data) if at else 0 : starts[at + most] if at + most < n - 1 else len(data)] if texts else None
                        out.append((i, k, at, min(most, n - at), piece))
                held += len(data) if texts else 100
                if held > BATCH:
                    yield table(out)
                    out, held = [], 0
            if out:
                yield table(out)

    def table(rows):
        i, k, at, n, piece = zip(*rows, strict=True)
        return pa.record_batch([pa.array(i, pa.int64()), pa.array(k, pa.int64()), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array([None if p is None else p.decode("utf-8", "surrogatepass") for p in piece], pa.string())], ["doc_id", "piece", "first_token", "n_tokens", "text"])

    return cut


def _salted(pieces: DataFrame, by_length: dict[int, int]) -> DataFrame:
    """Adds a salt below the number of windows that a length's pieces fill."""
    salts = pieces.sparkSession.createDataFrame([(n, -(-held // RANKED)) for n, held in by_length.items()], "n_tokens long, salts long")
    return pieces.join(F.broadcast(salts), "n_tokens").withColumn("salt", F.pmod(F.xxhash64("number"), F.col("salts"))).drop("salts")


def packed_documents(docs: DataFrame, sizes: Sequence[int] = SIZES, texts: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, first_token, n_tokens, bin_id, bin_offset, bin_size, and with texts the piece's
    part of the text (the parts of a document make up its text)."""
    spark = docs.sparkSession
    pieces = written(docs.select("doc_id", "text").mapInArrow(_cut(max(sizes), texts), "doc_id long, piece long, first_token long, n_tokens long, text string").withColumn("number", F.monotonically_increasing_id()), "pieces")
    by_length = {r.n_tokens: r.n for r in pieces.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}  # a row a length, max(sizes) at most
    plan = pack(by_length, sizes)
    pieces = _salted(pieces, by_length)
    counts = pieces.groupBy("n_tokens", "salt").count()
    shared = Shared(spark, plan)
    whole = {"bin_id": T.LongType(), "bin_offset": T.LongType(), "bin_size": T.LongType()}

    @F.arrow_udf(T.StructType([T.StructField(k, v) for k, v in whole.items()]))
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        out = shared.value.place(length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x) for x in out], list(whole))

    before = counts.withColumn("before", F.coalesce(F.sum("count").over(Window.partitionBy("n_tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("n_tokens", "salt").orderBy("number")) - 1
    ranked = pieces.withColumn("within", within).join(before.select("n_tokens", "salt", "before"), ["n_tokens", "salt"])
    out = ranked.select("doc_id", "piece", "first_token", "n_tokens", "text", place(F.col("n_tokens"), F.col("within") + F.col("before")).alias("at"))
    return out.select("doc_id", "piece", "first_token", "n_tokens", "at.*", *(["text"] if texts else []))
