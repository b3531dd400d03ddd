"""SimHash near-duplicates by a segment-popcount embedding and a grid range-join under Manhattan distance.

A 64-bit fingerprint is cut into 32 segments of two bits; the vector of their bit counts (0, 1 or 2 each) is its embedding.
Flipping one bit moves one count by one, so the Manhattan distance of two embeddings never exceeds the number of differing
bits: embeddings further apart than MOST_BITS cannot be a link. Written in unary (0 -> 00, 1 -> 01, 2 -> 11) the embedding is
again 64 bits wide and the Manhattan distance is the bit count of an XOR.

The 32 axes form two sub-grids of 16. Of two embeddings within distance 3, one sub-grid holds them within distance 1, that is
in the same cell or in cells one step apart. Each distinct fingerprint is stored in its cell of either sub-grid and probes the
cells one step up (a step down is the other one's step up), so every link meets in a cell: an equi-join on cells with about
28 short rows a fingerprint. Met pairs pass the Manhattan bound over all axes, then the exact Hamming distance.

Exact copies are one node. A cell with many fingerprints never emits its pairs: its task keeps a forest that spans them.
Cells above BLOCK stored fingerprints are cut into blocks which each meet all of the cell's rows, so no task holds more than
one block, and no pair is lost.

Edge cases: a null or empty text and one of white space only has fingerprint 0, linked like any other; fewer than three words
make one shingle; repeated rows and repeated doc_ids stay separate rows; a null doc_id is never a smallest one, and a class of
null ids only has a null component; other columns, whatever they are called, are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.common import broadcast_if_small, free_name, written
from strataforge.llm.components import connected_components

MOST_BITS = 3
SHINGLE = 3
SEED = 42
#: Stored fingerprints of one cell that a task holds at once.
BLOCK = 2048
#: Shingles whose hashes are in memory at once.
AT_ONCE = 1 << 15
LOW = np.uint64(0x5555555555555555)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of the UTF-8 bytes of a text: a bit is 1 if it is set in over half of the shingles' XXH64."""
    found = text.lower().split()  # bytes: only A-Z change, only \x20 and \x09-\x0D separate
    if not found:
        return 0
    if len(found) < size:
        found, size = [b" ".join(found)], 1
    n, counts = len(found) - size + 1, np.zeros(64, np.int64)
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    for k in range(0, n, AT_ONCE):
        part = found[k : k + AT_ONCE + size - 1]
        joined = part if size == 1 else map(b" ".join, zip(*(part[i:] for i in range(size)), strict=False))
        hashes = np.fromiter(map(digest, joined), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


@F.arrow_udf(T.LongType())
def simhash64(text: pa.Array) -> pa.Array:
    """The fingerprint of each text as a signed long; null counts as empty."""
    return pa.array((fingerprint((x.as_py() or "").encode("utf-8", "surrogatepass")) for x in text), pa.int64())


def unary(x: np.ndarray) -> np.ndarray:
    """The embedding of uint64 fingerprints: two-bit segments, their bit counts in unary."""
    one = np.uint64(1)
    return ((x | (x >> one)) & LOW) | ((x & (x >> one) & LOW) << one)


def cells(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, fp, role) of uint64 fingerprints; role 0: stored in its cell, 1: probes a cell one step up.
    A cell is 33 bits: the sub-grid's number and its half of the embedding."""
    grid = unary(fp)
    out = []
    for half in (0, 1):
        own = (grid >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        name = np.uint64(half << 32)
        out.append((own | name, fp, np.zeros(len(fp), np.int8)))
        for axis in range(16):
            first, second = np.uint64(1 << 2 * axis), np.uint64(2 << 2 * axis)
            step = np.where(own & first == 0, first, second)
            may = own & second == 0
            out.append(((own | step | name)[may], fp[may], np.ones(int(may.sum()), np.int8)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _emit_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cell, fp, role = cells(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        yield pa.record_batch([pa.array(cell.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(role)], ["cell", "fp", "role"])


def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether fingerprints are links: Manhattan bound first, then the exact distance."""
    may = np.bitwise_count(unary(a) ^ unary(b)) <= MOST_BITS
    return may & (np.bitwise_count(a ^ b) <= MOST_BITS)


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least index reachable from each of n, along links (u, v)."""
    label = np.arange(n)
    while True:
        least, before = np.minimum(label[u], label[v]), label.copy()
        np.minimum.at(label, u, least)
        np.minimum.at(label, v, least)
        label = label[label]
        if np.array_equal(before, label):
            return label


def _forest(stored: np.ndarray, others: np.ndarray, among: bool) -> tuple[np.ndarray, np.ndarray]:
    """A forest that connects what links between stored and others (and among stored) connect: one edge a fingerprint at most.
    An edge between two stored ones may stand for a chain of links."""
    u, v, ends = [], [], []
    if among:
        for k in range(0, len(stored), 512):
            i, j = np.nonzero(close(stored[k : k + 512, None], stored[None, :]))
            u.append(i + k)
            v.append(j)
    for k in range(0, len(others), 512):
        i, j = np.nonzero(close(others[k : k + 512, None], stored[None, :]))
        if len(i):
            starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            first = np.repeat(j[starts], np.diff(np.r_[starts, len(i)]))
            ends.append((others[i[starts] + k], stored[j[starts]]))
            u.append(first)
            v.append(j)
    if u:
        label = _roots(len(stored), np.concatenate(u), np.concatenate(v))
        moved = np.flatnonzero(label != np.arange(len(stored)))
        ends.append((stored[moved], stored[label[moved]]))
    if not ends:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends])


def _links_of_runs(cell, block, role, fp) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within whole runs of equal (cell, block); rows are sorted by cell, block, role."""
    start = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (block[1:] != block[:-1])])
    length = np.diff(np.r_[start, len(cell)])
    kept = np.add.reduceat((role == 0).astype(np.int64), start)
    work = (kept > 0) & (length > 1)
    small = work & (kept <= 4) & (length <= 64)
    s, n, m = start[small], length[small], kept[small]
    for offset in range(4):  # stored row number `offset` of each small run against the rows after it
        has = m > offset
        base, reach = s[has] + offset, n[has] - offset - 1
        left = np.repeat(base, reach)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(reach) - reach, reach)
        ok = close(fp[left], fp[right])
        yield fp[left[ok]], fp[right[ok]]
    for i in np.flatnonzero(work & ~small):
        a, b = start[i], start[i] + kept[i]
        yield _forest(fp[a:b], fp[b : start[i] + length[i]], True)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams rows sorted by (cell, block, role, fp): of the run that goes on over a batch's end it keeps the rows, or for a
    long run the stored ones only (BLOCK at most)."""
    def table(pairs):
        u, v = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (list(zip(*pairs, strict=True)) or ([], [])))
        apart = u != v
        return pa.record_batch([pa.array(u[apart].view(np.int64)), pa.array(v[apart].view(np.int64))], ["u", "v"])

    rest, joined = None, False
    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        now[3] = now[3].view(np.uint64)
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
        cell, block, role, fp = now
        if not len(cell):
            continue
        changes = np.flatnonzero((cell[1:] != cell[:-1]) | (block[1:] != block[:-1])) + 1
        cut, pairs = (int(changes[-1]) if len(changes) else 0), []
        begin = 0
        if cut and joined:  # the long run ends here: its stored rows have met each other before
            begin = int(changes[0])
            kept = int((role[:begin] == 0).sum())
            pairs.append(_forest(fp[:kept], fp[kept:begin], False))
            joined = False
        if cut > begin:
            pairs += _links_of_runs(cell[begin:cut], block[begin:cut], role[begin:cut], fp[begin:cut])
        rest = [x[cut:] for x in now]
        if len(rest[0]) > 4 * BLOCK and rest[2][-1] == 1:
            kept = int((rest[2] == 0).sum())
            pairs.append(_forest(rest[3][:kept], rest[3][kept:], not joined))
            rest, joined = [x[:kept] for x in rest], True
            if not kept:  # probes only: nothing to meet, one row keeps the place of the run
                rest = [x[cut : cut + 1] for x in now]
        yield table(pairs)
    if rest is not None and len(rest[0]):
        kept = int((rest[2] == 0).sum())
        if joined:
            yield table([_forest(rest[3][:kept], rest[3][kept:], False)])
        else:
            yield table(list(_links_of_runs(*rest)))


def fingerprint_links(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """nodes: one row per distinct fingerprint (fp long). Returns links (u, v) that connect exactly what links within
    MOST_BITS connect (in crowded cells a spanning part of the links, elsewhere all)."""
    rows = nodes.select("fp").mapInArrow(_emit_cells, "cell long, fp long, role byte")
    crowded = written(rows.filter("role = 0").groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > block).select("cell", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "crowded")
    if crowded.isEmpty():
        dealt = rows.select("cell", F.lit(0).alias("block"), "role", "fp")
    else:
        both = rows.join(broadcast_if_small(crowded, 100_000), "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own = F.array(F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        dealt = both.select("cell", "role", "fp", F.explode(F.when(F.col("role") == 0, own).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("block"))
        # stored rows probe the other blocks of their cell
        others = both.filter("role = 0 and blocks > 1").select("cell", F.lit(1).cast("byte").alias("role"), "fp", F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != own[0])).alias("block"))
        dealt = dealt.unionByName(others).select("cell", "block", "role", "fp")
    return dealt.repartition("cell", "block").sortWithinPartitions("cell", "block", "role", "fp").mapInArrow(_links, "u long, v long")


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns (rows, classes): rows has the carried columns of docs (doc_id by default; none may be called fp) with the
    fingerprint fp, written out; classes has one row per distinct fingerprint (class_fp) with component_id, the smallest doc_id
    that its links reach."""
    if "fp" in map(str.lower, carry or [doc_id]):
        raise ValueError("a carried column is called fp")
    rows = written(docs.select(*(carry or [doc_id]), simhash64(F.col(text)).alias("fp")), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min(doc_id).alias("first")), "nodes")
    labels = written(connected_components(fingerprint_links(nodes)), "labels")
    named = nodes.join(labels, nodes.fp == labels.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows, named.join(least, "root").select(F.col("fp").alias("class_fp"), "component_id")


def simhash_components(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 lower-case hex digits) and component_id."""
    rows, classes = near_duplicate_classes(docs.select("doc_id", "text"), carry=["doc_id"])
    return rows.join(classes, rows.fp == classes.class_fp).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs without near-duplicates: of each class the row with the smallest doc_id stays (null ids last; of rows
    that repeat an id the earliest stored). Columns are those of docs. Texts are shuffled once, by a row number without skew."""
    number = free_name(docs, "row_number")
    numbered = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    rows, classes = near_duplicate_classes(numbered.select(F.col(number), F.col(doc_id).alias("_id"), F.col(text).alias("_text")), "_id", "_text", carry=[number, "_id"])
    order = F.struct(F.col("_id").isNull(), F.col("_id"), F.col(number))
    kept = rows.join(classes, rows.fp == classes.class_fp).groupBy(F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("class_fp")))).agg(F.min(order)[number].alias("kept"))
    return numbered.join(kept, numbered[number] == kept.kept, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
