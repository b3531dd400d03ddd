"""Near copies of the pipeline by SimHash: fingerprints of five-word shingles, their segment-popcount embedding, a grid join under
Manhattan distance, then exact distances; links are pairs met with an exact Jaccard of 0.8 or more of their shingles.

The method is that of simhash.py with another radius: at Jaccard 0.8 a sixth of the bits differ (cosine 8/9), up to 14 of 64, which
no step on two sub-grids reaches. So a fingerprint has WORDS words of 64 bits, the bits of each from own hashes of the shingles, and
the sub-grids are many and small: each word's 32 axes (bit counts of its two-bit segments, in unary) give five of AXES axes, 60 in all.
Texts meet that are in the same cell of any sub-grid. At Jaccard 0.8 one sub-grid holds two texts in the same cell with a chance of
0.16, so all but about 1 in 30,000 of those pairs meet (calculated) and more above it; very small sets do less well (of sets of 4
in sets of 5 about 1 in 100 is lost, simulated).

Meeting has two steps, as a cell also holds texts that are not alike. First the rows of a cell carry FIRST words of the fingerprint and
the number of shingles: as links have at least 0.8 times as many of them as each other, a cell's rows are put in order of that number
and each only meets the stretch of those in reach. Then the Manhattan bound on the embedding, then the exact distance, both at
most FIRST_BITS. It only tells which texts have company in which cell. The second step is for those, with whole fingerprints and MOST_BITS. Its pairs are compared by their whole sets of shingle hashes.

Texts with equal sets are one node. A large group does not emit all its pairs: first every node meets the NEXT nodes of its cell,
in the order of their fingerprints, and the one nearest to the cell's commonest bits; the links found make components. Then only
nodes of different components meet, all of them: those outside the cell's largest component meet every node of the cell. Crowded
cells are cut, CROWDED nodes to a block in the first step and OUTSIDE of those nodes in the second; a task streams the cell's other
rows past one block. A pair that shares several cells is only emitted in the first of them.

Edge cases: null, empty and white-space texts are one node; fewer than five words make one shingle; repeated rows and repeated
doc_ids are separate rows; null ids come last; other columns, whatever they are called, are carried along; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm.common import broadcast_if_small, drop_written, free_name, written
from strataforge.llm.components import connected_components
from strataforge.llm.simhash import unary

SHINGLE, SIMILAR = 5, 0.8
#: Words of a fingerprint; axes of a sub-grid, five to a word.
WORDS, AXES = 12, 6
GRIDS = WORDS * 5
#: Words that meet first, and bits that may differ in them.
FIRST, FIRST_BITS = 2, 36
#: Words of the fingerprints of texts with company; bits that may differ, and what is added to them over the lesser number of shingles.
LONG, MOST_BITS, MORE_BITS = 32, 378, 410
NEXT = 8
#: Nodes of a block in the first step; rows of a cell that meet at once in the second, and nodes of a block there.
CROWDED, PIECE, OUTSIDE = 1 << 16, 8192, 1 << 14
SEED = 42
#: Shingles whose bits are in memory at once: their counts fit a byte.
AT_ONCE = 255
_rng = np.random.default_rng(SEED)
PLUS = _rng.integers(0, 1 << 63, LONG).astype(np.uint64)
MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct XXH64 of a text's shingles; A-Z count as lower case, only \\x20 and \\x09-\\x0D separate words."""
    found, size = (text or "").encode("utf-8", "surrogatepass").lower().split(), SHINGLE
    if len(found) < size:
        found, size = [b" ".join(found)], 1
    joined = map(b" ".join, zip(*(found[i:] for i in range(size)), strict=False))
    return np.unique(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), joined), np.uint64))


def fingerprint(found: np.ndarray, n: int = WORDS) -> np.ndarray:
    """SimHash of a set of shingle hashes: a bit is 1 if it is set in over half of the hashes that each of n words makes of them."""
    counts = np.zeros(64 * n, np.int64)
    for k in range(0, len(found), AT_ONCE):
        h = found[k : k + AT_ONCE, None] + PLUS[:n]
        h = (h ^ (h >> np.uint64(30))) * MIX[0]
        h = (h ^ (h >> np.uint64(27))) * MIX[1]
        h ^= h >> np.uint64(31)
        counts += np.unpackbits(h.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(found), bitorder="little").view(np.uint64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def cells_of(fp: np.ndarray) -> np.ndarray:
    """The cells of fingerprints (a row each): the sub-grid's number and AXES axes of the embedding."""
    bits = 2 * AXES
    own = unary(fp[:, :WORDS])[:, :, None] >> (np.arange(5) * bits).astype(np.uint64) & np.uint64((1 << bits) - 1)
    return own.reshape(len(fp), GRIDS).astype(np.int32) + (np.arange(GRIDS) << bits).astype(np.int32)


def _apart_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits, over the words in the last axis."""
    out = np.bitwise_count(a[..., 0] ^ b[..., 0]).astype(np.uint16)
    for w in range(1, a.shape[-1]):
        out += np.bitwise_count(a[..., w] ^ b[..., w])
    return out


def _close(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of a and b that differ in FIRST_BITS bits of the first words at most: Manhattan distance of the
    embeddings first, which is never more, then the exact distance."""
    a, b = a[:, :FIRST], b[:, :FIRST]
    i, j = np.nonzero(_apart_bits(unary(a)[:, None], unary(b)[None, :]) <= FIRST_BITS)
    near = _apart_bits(a[i], b[j]) <= FIRST_BITS
    return i[near], j[near]


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of long fingerprints, each followed by its number of shingles, may be links: by those numbers, by the Manhattan
    distance, then by the exact distance."""
    less, more = np.minimum(a[:, LONG], b[:, LONG]), np.maximum(a[:, LONG], b[:, LONG])
    out = less >= SIMILAR * more
    for embedded in (unary, lambda x: x):
        i = np.flatnonzero(out)
        out[i] = _apart_bits(embedded(a[i, :LONG]), embedded(b[i, :LONG])) <= MOST_BITS + MORE_BITS // less[i]
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, fps, sizes = [], [], []
        for text in batch.column(2):
            found = shingles(text.as_py())
            nodes.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
            fps.append(fingerprint(found).tobytes())
            sizes.append(len(found))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(fps, pa.binary()), pa.array(sizes, pa.int32())], ["number", "id", "node", "fp", "size"])


def _whole(column: pa.Array, n: int = LONG + 1) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, n)


def _emit_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each cell of each node, with the first words of its fingerprint."""
    for batch in (x.slice(k, 512) for x in batches for k in range(0, x.num_rows, 512)):
        node, fp = batch.column(0).to_numpy(), _whole(batch.column(1), WORDS)
        words = [pa.array(np.repeat(fp[:, w], GRIDS).view(np.int64)) for w in range(FIRST)]
        size = pa.array(np.repeat(batch.column(2).to_numpy(), GRIDS))
        yield pa.record_batch([pa.array(cells_of(fp).ravel()), pa.array(np.repeat(node, GRIDS)), *words, size], ["cell", "node", "a", "b", "size"])


def _meets(own: np.ndarray, size: np.ndarray, others: np.ndarray, sizes: np.ndarray, among: bool) -> np.ndarray:
    """Which of own have company in others (among: others is own, and a row is no company to itself). Both are in order of their
    numbers of shingles, of which only those in reach of each other are compared."""
    found = np.zeros(len(own), bool)
    for k in range(0, len(own), 64):
        least, most = size[k], size[min(k + 64, len(own)) - 1]
        low = k if among else int(np.searchsorted(sizes, np.ceil(SIMILAR * least - 1e-9)))
        high = int(np.searchsorted(sizes, np.floor(most / SIMILAR + 1e-9), "right"))
        for m in range(low, high, 1024):
            i, j = _close(own[k : k + 64], others[m : min(m + 1024, high)])
            i, j = i + k, j + m
            if among:
                i, j = (x[i < j] for x in (i, j))
            near = np.minimum(size[i], sizes[j]) >= SIMILAR * np.maximum(size[i], sizes[j]) - 1e-9
            found[i[near]] = True
            if among:
                found[j[near]] = True
    return found


def _dealt(rows: DataFrame, most: int) -> DataFrame:
    """rows (cell, ...) dealt by cell, then sorted by cell, block and role, which come last. Cells of more than `most` rows are cut
    into blocks: a row has role 0 in its own block and 1 in the others, elsewhere all are in one block with role 0."""
    counts = rows.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > most)
    crowded = written(counts.select("cell", F.ceil(F.col("n") / most).cast("int").alias("blocks")), "crowded")
    if crowded.isEmpty():
        dealt = rows.select(*rows.columns, F.lit(0).alias("block"), F.lit(0).alias("role"))
    else:
        both = rows.join(broadcast_if_small(crowded, 100_000), "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        dealt = both.select(*rows.columns, own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        dealt = dealt.select(*rows.columns, "block", (F.col("block") != F.col("own")).cast("int").alias("role"))
    return dealt.repartition("cell", "block").sortWithinPartitions("cell", "block", "role")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """(cell, block), role and rows of the stretches of what _dealt has sorted."""
    for batch in batches:
        cell, block, role = (batch.column(c).to_numpy() for c in ("cell", "block", "role"))
        cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (block[1:] != block[:-1]) | (role[1:] != role[:-1])) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cell)], strict=True):
            if i < j:
                yield (int(cell[i]), int(block[i])), int(role[i]), batch.slice(i, j - i)


def _company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows (cell, node, a, b, size) of a block those that are close to any other one of their cell."""
    place, own, met = None, [], None

    def in_order(rows: list[np.ndarray]) -> list[np.ndarray]:
        order = np.argsort(rows[2], kind="stable")
        return [x[order] for x in rows]

    def among() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        node, fp, size = in_order([np.concatenate(x) for x in zip(*own, strict=True)])
        return node, fp, size, _meets(fp, size, fp, size, True)

    def company() -> pa.RecordBatch:
        node, _, _, found = met or among()
        return pa.record_batch([pa.array(np.full(int(found.sum()), place[0], np.int32)), pa.array(node[found])], ["cell", "node"])

    for here, role, rows in _runs(batches):
        if place != here:
            if own:
                yield company()
            place, own, met = here, [], None
        fp = np.stack([rows.column(c).to_numpy() for c in ("a", "b")], 1).view(np.uint64)
        now = [rows.column("node").to_numpy(), fp, rows.column("size").to_numpy()]
        if role == 0:
            own.append(now)
        elif own:  # blocks are dealt by a hash, so one may have no node
            met = met or among()
            _, fp, size = in_order(now)
            met[3][:] |= _meets(met[1], met[2], fp, size, False)
    if own:
        yield company()


def _with_company(nodes: DataFrame) -> DataFrame:
    """(cell, node) for the nodes (node, fp, size) that are close to another one of a cell."""
    rows = nodes.select("node", "fp", "size").mapInArrow(_emit_cells, "cell int, node long, a long, b long, size int")
    return _dealt(rows, CROWDED).mapInArrow(_company, "cell int, node long")


def _first_shared(cell: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether a cell is the first that each of the pairs shares."""
    return one[np.arange(len(one)), (one == other).argmax(1)] == cell


def _pairs(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])


def _first_meetings(node: np.ndarray, fp: np.ndarray, run: np.ndarray) -> Iterator[pa.RecordBatch]:
    cells = cells_of(fp)

    def met(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        a, b = (x[_alike(fp[a], fp[b])] for x in (a, b))
        a, b = (x[_first_shared(run[a], cells[a], cells[b])] for x in (a, b))
        return _pairs(node[a], node[b])

    for far in range(1, min(NEXT, len(node) - 1) + 1):
        a = np.flatnonzero(run[far:] == run[:-far])
        yield met(a, a + far)
    start = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    for i, n in zip(start.tolist(), np.diff(np.r_[start, len(run)]).tolist(), strict=True):
        if n > NEXT + 1:
            own = np.ascontiguousarray(fp[i : i + n, :WORDS])
            common = np.packbits(np.unpackbits(own.view(np.uint8), axis=1).sum(0, dtype=np.int32) * 2 > n).view(np.uint64)
            middle = i + int(_apart_bits(own, common).argmin())
            others = np.setdiff1d(np.arange(i, i + n), [middle])
            yield met(np.repeat(middle, len(others)), others)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cell, node, fp, sorted. Of every cell, nodes at most NEXT rows apart, and all with the one in their middle; a run that
    goes over a batch's end is held up to PIECE rows."""
    held: list[pa.RecordBatch] = []
    for batch in (x.slice(k, PIECE) for x in batches for k in range(0, x.num_rows, PIECE)):
        cell = batch.column(0).to_numpy()
        last = int(np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])[-1])
        held.append(batch.slice(0, last) if last else batch)
        if last or sum(x.num_rows for x in held) >= PIECE:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from _first_meetings(table["node"].to_numpy(), _whole(table["fp"]), table["cell"].to_numpy())
            held = [batch.slice(last)] if last else []
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield from _first_meetings(table["node"].to_numpy(), _whole(table["fp"]), table["cell"].to_numpy())


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes (cell, node, fp, label) of a block and all nodes of their cell, if they may be links and their labels differ."""
    def met(one: list[np.ndarray], other: list[np.ndarray], among: bool) -> Iterator[pa.RecordBatch]:
        (cell, node, fp, label), (_, nodes, fps, labels) = one, other
        for k in range(0, len(node), 64):
            for m in range(k if among else 0, len(nodes), 1024):
                i, j = _close(fp[k : k + 64], fps[m : m + 1024])
                i, j = i + k, j + m
                apart = (label[i] != labels[j]) & (i < j if among else True)
                i, j = i[apart], j[apart]
                i, j = (x[_alike(fp[i], fps[j])] for x in (i, j))
                if len(i):
                    first = _first_shared(cell[i], cells_of(fp[i]), cells_of(fps[j]))
                    yield _pairs(node[i[first]], nodes[j[first]])

    place, own, whole = None, [], None
    for here, role, rows in _runs(batches):
        if place != here:
            if own and whole is None:
                whole = [np.concatenate(x) for x in zip(*own, strict=True)]
                yield from met(whole, whole, True)
            place, own, whole = here, [], None
        now = [rows.column("cell").to_numpy(), rows.column("node").to_numpy(), _whole(rows.column("fp")), rows.column("label").to_numpy()]
        if role == 0:
            own.append(now)
        elif own:
            if whole is None:
                whole = [np.concatenate(x) for x in zip(*own, strict=True)]
                yield from met(whole, whole, True)
            yield from met(whole, now, False)
    if own and whole is None:
        whole = [np.concatenate(x) for x in zip(*own, strict=True)]
        yield from met(whole, whole, True)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t.as_py()) for t in batch.column(1)]
        fps = [fingerprint(x, LONG).tobytes() + np.uint64(len(x)).tobytes() for x in found]
        yield pa.record_batch([batch.column(0), pa.array(fps, pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())], ["node", "fp", "found"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = ([np.frombuffer(x.as_py(), np.uint64) for x in batch.column(c)] for c in ("a", "b"))
        near = pa.array([jaccard(x, y) >= SIMILAR for x, y in zip(a, b, strict=True)], pa.bool_())
        yield batch.select(["u", "v"]).filter(near)


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (u, v) that are links."""
    pairs = written(pairs.distinct(), "pairs")
    left, right = (sets.select(F.col("node").alias(n), F.col("found").alias(c)) for n, c in (("u", "a"), ("v", "b")))
    return written(pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(_links, "u long, v long"), "links-checked")


def near_classes(docs: DataFrame, number: str, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (number, id, node) of a written table and the roots (node, root) of nodes that have links, both written; what else was
    written on the way is deleted."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    made = []

    def made_of(df: DataFrame, label: str) -> DataFrame:
        made.append(written(df, label))
        return made[-1]

    every = made_of(docs.select(number, doc_id, text).mapInArrow(_fingerprints, f"number long, id {id_type}, node long, fp binary, size int"), "fingerprints")
    nodes = made_of(every.groupBy("node").agg(F.min("number").alias("number"), F.first("fp").alias("fp"), F.first("size").alias("size")), "nodes")
    near = made_of(_with_company(nodes), "near")
    some = nodes.join(near.select("node").distinct(), "node", "left_semi").select("node", "number")
    texts = some.join(docs.select(F.col(number).alias("number"), F.col(text).alias("text")), "number").select("node", "text")
    sets = made_of(texts.mapInArrow(_sets, "node long, fp binary, found binary"), "sets")
    cells = near.groupBy("node").agg(F.collect_list("cell").alias("cells"))
    met = made_of(sets.select("node", "fp").join(cells, "node"), "met")
    rows = met.select(F.explode("cells").alias("cell"), "node", "fp")
    first = _checked(rows.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(_neighbours, "u long, v long"), sets)
    labels = made_of(connected_components(first), "labels")
    labelled = made_of(met.join(labels, met.node == labels.node, "left").select(met.node, "fp", "cells", F.coalesce("root", met.node).alias("label")), "labelled")
    rows = labelled.select(F.explode("cells").alias("cell"), "node", "fp", "label")
    second = _checked(_dealt(rows, OUTSIDE).mapInArrow(_apart, "u long, v long"), sets)
    roots = written(connected_components(first.unionByName(second)), "roots")
    rows = written(every.select("number", "id", "node"), "rows")
    for df in made:
        drop_written(df)
    return rows, roots


def keep_one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs without near copies: of each component of links the row with the smallest doc_id stays (null ids last;
    of rows that repeat an id the earliest stored). Columns are those of docs."""
    number = free_name(docs, "row_number")
    numbered = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    rows, roots = near_classes(numbered, number, doc_id, text)
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("number"))
    kept = rows.join(roots, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min(order)["number"].alias("kept"))
    return numbered.join(kept, numbered[number] == kept.kept, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
