"""SentencePiece encoding and decoding for merge-type vocabularies, by a score-ordered agenda of adjacent symbol pairs.

A text is normalised (spaces become the vocabulary's mark, one mark goes before the text) and its characters are the first symbols.
The agenda holds every pair of neighbours whose joined text is a piece, best score first, of equal scores the leftmost; the
best is merged, its new neighbours join the agenda, and pairs that a merge has broken are passed over when their turn comes. What
is left are pieces, or characters without one, which become pieces of their bytes.

Two characters that stand next to each other in no piece can never be merged, so a text falls apart between them: first at
marks (no piece has one behind another character), then at any such pair. Chunks recur, so the different ones of a group of texts
go through their agendas once, together (long ones through a heap each, cut at pairs first), and are checked against the
sentencepiece library; a difference stops the job. check="texts" holds whole texts against the library as well. Ids go back to
text by the library's own decode.

The model file's bytes are read by the driver and travel with the task; its size bounds the broadcast. No row needs another, so
nothing is shuffled. Models of other types, with symbols of the user's, or without byte pieces are refused.

Edge cases: a null text counts as empty, an empty text has no ids and decodes to nothing; the mark itself in a text reads as a
space, as in the library; characters outside the vocabulary become bytes; runs without any break go through the agenda whole,
whatever their length; repeated rows get equal results; ids of any type, null too, are passed on; other columns are ignored,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.common import Shared

MARK = "▁"
#: Characters of a chunk up to which agendas are rows of one table, and rows of it; bytes of texts that are encoded together.
SHORT, ROWS, GROUP = 24, 4096, 12 << 20
#: Rows of a batch of results.
GIVEN = 250
#: Symbols that are no pieces.
OTHERS = 1 << 24


class Vocabulary:
    """Pieces by their order of merging, ids, byte pieces and the pairs of characters that occur within pieces."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        parsed = proto.ModelProto()
        parsed.ParseFromString(model)
        trainer, rules = parsed.trainer_spec, parsed.normalizer_spec
        kind = proto.ModelProto.SentencePiece
        if trainer.model_type != proto.TrainerSpec.BPE:
            raise ValueError("only merge-type (BPE) models are supported")
        if not trainer.byte_fallback:
            raise ValueError("a model without byte pieces is not supported")
        if trainer.treat_whitespace_as_suffix or rules.remove_extra_whitespaces or rules.precompiled_charsmap or not rules.add_dummy_prefix or not rules.escape_whitespaces:
            raise ValueError("only models with the identity normalisation and one mark before the text are supported")
        self.model = model
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        scores: dict[str, float] = {}
        for i, piece in enumerate(parsed.pieces):
            if piece.type in (kind.USER_DEFINED, kind.UNUSED):
                raise ValueError("symbols of the user's and unused pieces are not supported")
            if piece.type == kind.BYTE:
                self.bytes[int(piece.piece[3:5], 16)] = i
            elif piece.type == kind.NORMAL:
                self.ids[piece.piece], scores[piece.piece] = i, piece.score
        turn = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        #: The lower, the earlier a pair that makes this piece is merged; the lower 32 bits are left for its place.
        self.turn = {p: turn[s] << 32 for p, s in scores.items()}
        self.pairs = {pair for p in scores for pair in zip(p, p[1:], strict=False)}
        if any(pair[1] == MARK != pair[0] for pair in self.pairs):
            raise ValueError("pieces with a mark behind other characters are not supported")
        # symbols as numbers: pieces by id, other characters from OTHERS on; and every pair of them that joins into a piece
        self.symbols = np.arange(OTHERS, OTHERS + 0x110000, dtype=np.int32)
        singles = [p for p in self.ids if len(p) == 1]
        self.symbols[[ord(p) for p in singles]] = [self.ids[p] for p in singles]
        number = lambda x: self.ids[x] if x in self.ids else OTHERS + ord(x) if len(x) == 1 else None
        # a pair's value: its turn, and in the lower bits the piece that it makes
        self.bits = len(parsed.pieces).bit_length()
        joins = [(a << 32 | b, turn[scores[p]] << self.bits | self.ids[p]) for p in scores for k in range(1, len(p)) if (a := number(p[:k])) is not None and (b := number(p[k:])) is not None]
        keys, values = zip(*sorted(joins), strict=True)
        kind = np.int32 if max(values) < np.iinfo(np.int32).max else np.int64
        self.keys, self.values, self.never = np.array(keys, np.int64), np.array(values, kind), kind(np.iinfo(kind).max)
        shared = Counter(s for p, s in scores.items() if len(p) > 1)  # single characters are made by no pair
        tied = [p for p, s in scores.items() if len(p) > 1 and shared[s] > 1]
        #: Pieces with another's score: between them the leftmost pair comes first, which the values above do not tell.
        self.tied = re.compile("|".join(re.escape(p) for p in tied)) if tied else None

    def _values(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Values of pairs; `never` of those that make no piece."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.values[at], self.never)

    def agendas(self, chunks: list[str]) -> list[bytes]:
        """The ids of many chunks at once, as bytes: a row of symbols each, beside it its agenda, the values of its pairs. In every round
        each row takes the pair with the least, whose turn comes first (of equal ones the leftmost), and its two neighbours get
        new ones. Chunks with tied pieces are not for it."""
        out: list[bytes] = [b""] * len(chunks)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(sizes, kind="stable")
        for low in range(0, len(order), ROWS):
            some = order[low : low + ROWS]
            wide = int(sizes[some[-1]])
            rows = np.full((len(some), wide + 1), -1, np.int32)
            points = np.frombuffer("".join([chunks[i] for i in some]).encode("utf-32-le", "surrogatepass"), np.uint32)
            rows[np.arange(wide + 1) < sizes[some, None]] = self.symbols[points]
            pairs = np.flatnonzero((rows[:, 1:] >= 0).ravel())
            waiting = np.full((len(some), wide), self.never, self.values.dtype)
            waiting.ravel()[pairs] = self._values(rows[:, :-1].ravel()[pairs], rows[:, 1:].ravel()[pairs])
            columns = np.arange(wide + 1)
            while len(some):
                best = waiting.argmin(axis=1)
                value = waiting[np.arange(len(some)), best]
                open_ = value != self.never
                if not open_.all():
                    self._finish(rows[~open_], some[~open_], out)
                    some, rows, waiting, best, value = some[open_], rows[open_], waiting[open_], best[open_], value[open_]
                    if not len(some):
                        break
                every = np.arange(len(some))
                made = (value & ((1 << self.bits) - 1)).astype(np.int32)
                after = np.minimum(columns + (columns > best[:, None]), wide)
                rows = np.take_along_axis(rows, after, 1)
                rows[every, best] = made
                waiting = np.take_along_axis(waiting, np.minimum(after[:, :-1], wide - 1), 1)
                waiting[every, best] = self._values(made, rows[every, best + 1])
                inner = np.flatnonzero(best > 0)
                before = best[inner] - 1
                waiting[inner, before] = self._values(rows[inner, before], made[inner])
        return out

    def _finish(self, rows: np.ndarray, which: np.ndarray, out: list[bytes]) -> None:
        """Rows of symbols as bytes of ids; characters that are no pieces become their bytes' pieces."""
        there = rows >= 0
        odd = (rows >= OTHERS).any(axis=1)
        ends = np.cumsum(there.sum(axis=1)) * 4
        flat = rows[there].tobytes()
        start = 0
        for i, end, other in zip(which.tolist(), ends.tolist(), odd.tolist(), strict=True):
            out[i] = flat[start:end]
            if other:
                out[i] = array("i", [x for symbol in np.frombuffer(out[i], np.int32).tolist() for x in (self._spelt(symbol - OTHERS) if symbol >= OTHERS else (symbol,))]).tobytes()
            start = end

    def _spelt(self, point: int) -> list[int]:
        return [self.bytes[b] for b in chr(point).encode("utf-8", "surrogatepass")]

    def agenda(self, chunk: str) -> array:
        """The ids of a chunk of normalised text of any length; the agenda is a heap."""
        turn, last = self.turn.get, len(chunk) - 1
        symbols: list[str] = list(chunk)
        before, after = list(range(-1, last)), [*range(1, last + 1), -1]
        waiting = [found | k for k in range(last) if (found := turn(chunk[k : k + 2])) is not None]
        heapq.heapify(waiting)
        while waiting:
            key = heapq.heappop(waiting)
            k = key & 0xFFFFFFFF
            right = after[k]
            if right < 0 or not symbols[k]:
                continue  # merged since, into what is on its left
            joined = symbols[k] + symbols[right]
            if turn(joined) != key - k:
                continue  # one of the two has grown since
            symbols[k], symbols[right] = joined, ""
            after[k] = beyond = after[right]
            if beyond >= 0:
                before[beyond] = k
                found = turn(joined + symbols[beyond])
                if found is not None:
                    heapq.heappush(waiting, found | k)
            left = before[k]
            if left >= 0:
                found = turn(symbols[left] + joined)
                if found is not None:
                    heapq.heappush(waiting, found | left)
        out = array("i")
        for symbol in symbols:
            if symbol:
                found = self.ids.get(symbol)
                if found is None:
                    out.extend(self.bytes[b] for b in symbol.encode("utf-8", "surrogatepass"))
                else:
                    out.append(found)
        return out

    def parts(self, chunk: str) -> Iterator[str]:
        """A chunk, cut wherever two neighbours stand next to each other in no piece."""
        start = 0
        for k, pair in enumerate(zip(chunk, chunk[1:], strict=False), 1):
            if pair not in self.pairs:
                yield chunk[start:k]
                start = k
        yield chunk[start:]


class Encoder:
    """Encodes texts by the group. Their different chunks, each without the mark it begins with, go through their agendas once."""

    CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def __init__(self, vocabulary: Vocabulary, library=None):
        self.vocabulary, self.library = vocabulary, library

    def solved(self, words: list[str]) -> list[bytes]:
        """The ids of chunks, as bytes of 32-bit numbers; long ones part by part."""
        tied = self.vocabulary.tied
        short, out = [], [b""] * len(words)
        for k, word in enumerate(words):
            if len(word) < SHORT and not (tied and tied.search(MARK + word)):
                short.append(k)
            else:
                out[k] = b"".join(self.vocabulary.agenda(part).tobytes() for part in self.vocabulary.parts(MARK + word))
        for k, ids in zip(short, self.vocabulary.agendas([MARK + words[k] for k in short]), strict=True):
            out[k] = ids
        return out

    def check(self, words: list[str], ours: list[bytes]) -> None:
        """Holds chunks against the library; a mark alone cannot be given to it."""
        if "" in words:
            words, ours = zip(*((w, x) for w, x in zip(words, ours, strict=True) if w), strict=True) if len(words) > 1 else ([], [])
        theirs = self.library.encode([word.replace(MARK, " ") for word in words], num_threads=1)
        if array("i", chain.from_iterable(theirs)).tobytes() == b"".join(ours) and [4 * len(x) for x in theirs] == list(map(len, ours)):
            return
        for word, ids, own in zip(words, theirs, ours, strict=True):
            if array("i", ids).tobytes() != own:
                raise ValueError(f"{word[:200]!r} is {ids[:50]} in the library, {np.frombuffer(own, np.int32)[:50].tolist()} here")

    def encode(self, texts: pa.Array) -> pa.Array:
        """A list of ids for each text. Arrow cuts the texts at spaces and finds the different words; texts in which marks stand side by
        side, first or last are cut here."""
        texts = pc.fill_null(texts, "")
        odd = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, MARK))
        for edge in (pc.equal(texts, ""), pc.starts_with(texts, " "), pc.ends_with(texts, " ")):
            odd = pc.or_(odd, edge)
        cut = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
        others = [[chunk[1:] for chunk in self.CHUNKS.findall(MARK + text.replace(" ", MARK))] if text else [] for text in texts.filter(odd).to_pylist()]
        words = pa.concat_arrays([cut.flatten().cast(pa.large_string()), pa.array(chain.from_iterable(others), pa.large_string())])
        counts = np.concatenate([pc.list_value_length(cut).to_numpy(zero_copy_only=False), np.fromiter(map(len, others), np.int64, len(others))]).astype(np.int64)
        coded = words.dictionary_encode()
        del cut, words, others
        different = coded.dictionary.to_pylist()
        ids = self.solved(different)
        if self.library is not None and different:
            self.check(different, ids)
        table = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) >> 2)]), np.frombuffer(b"".join(ids), np.int32))
        spread = table.take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(counts)])
        rows = pa.LargeListArray.from_arrays(spread.offsets.to_numpy()[ends] - spread.offsets[0].as_py(), spread.flatten())
        place = np.argsort(np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
        return rows.take(pa.array(place)).cast(pa.list_(pa.int32()))


class Library:
    """The library's processor of a model, made when a task first asks for it."""

    def __init__(self, model: bytes):
        self.model, self.made = model, None

    @property
    def processor(self):
        if self.made is None:
            import sentencepiece

            self.made = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        return self.made


def model_bytes(path: str | None = None) -> bytes:
    """The model file at path; by default the public tokenizers' merge-type model with 32,000 pieces."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


def encoded(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", check: str = "chunks", back: bool = False) -> DataFrame:
    """The id and `ids`, an array of the text's ids without begin or end; with back also `decoded`, what the library makes of them.
    check: chunks, or texts for whole texts too."""
    if check not in ("chunks", "texts"):
        raise ValueError("check is chunks or texts")
    shared = Shared(docs.sparkSession, Vocabulary(model))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = Library(shared.value.model).processor
        encoder = Encoder(shared.value, library)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).cumsum()
            first = 0
            while first < batch.num_rows:
                behind = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + GROUP, "right")))
                some = batch.slice(first, behind - first)
                ids = encoder.encode(some.column(1))
                if check == "texts":
                    for ours, theirs in zip(ids.to_pylist(), library.encode([t or "" for t in some.column(1).to_pylist()], num_threads=1), strict=True):
                        if ours != theirs:
                            raise ValueError(f"the library finds {theirs[:50]}, not {ours[:50]}")
                for at in range(0, len(ids), GIVEN):
                    part = ids.slice(at, GIVEN)
                    texts = [pa.array(library.decode(part.to_pylist(), num_threads=1), pa.string())] if back else []
                    yield pa.record_batch([some.column(0).slice(at, GIVEN), part, *texts], names)
                del ids
                pa.default_memory_pool().release_unused()
                first = behind

    kept = [T.StructField("id", docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))] + ([T.StructField("decoded", T.StringType())] if back else [])
    names = [f.name for f in kept]
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(encode, T.StructType(kept)).withColumnRenamed("id", id_col)


def decoded(spark: SparkSession, ids: Column, model: bytes) -> Column:
    """The text of an array of ids, by the library."""
    shared = Shared(spark, Library(model))

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        library, out = shared.value.processor, []
        for at in range(0, len(ids), 256):
            out += library.decode([x or [] for x in ids.slice(at, 256).to_pylist()], num_threads=1)
        return pa.array(out, pa.string())

    return decode(ids)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The query's columns: number of ids, digest of the ids, digest of what they decode to."""
    found = encoded(docs, model_bytes(path), back=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
