"""xz files in parts: the index at the end of a stream says where its blocks are, so tasks read blocks of their own.

A file is a row of streams, each with a header, blocks, an index and a footer. Only footers and indexes are read to plan; a task
then decodes the blocks it owns, each from its own start. Records that run over the end of a task's blocks are read on from the
next ones; a record belongs to the task in whose bytes it begins."""

from __future__ import annotations

import lzma
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from typing import IO

# Fixed values of the format: marks of headers and footers, and their lengths.
MAGIC, END_MAGIC = b"\xfd7zXZ\x00", b"YZ"
HEADER = FOOTER = 12
#: Bytes that are read, and decoded, at once.
PIECE = 1 << 20


@dataclass(frozen=True)
class Block:
    """A compressed block: where it is, its length without padding, its bytes when decoded, and the flags of its stream."""

    start: int
    length: int
    size: int
    flags: bytes


def opened(path: str) -> IO[bytes]:
    """A file of any store that Arrow knows, or of a folder that all executors see, for reading anywhere in it."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store.open_input_file(name)


def varint(data: bytes, at: int) -> tuple[int, int]:
    """A number of seven bits a byte, the lowest first, and the place behind it."""
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at
        if shift > 63:
            raise lzma.LZMAError("a number in an xz index is too long")


def blocks(file: IO[bytes]) -> list[Block]:
    """All blocks of a file in order, found from its end."""
    file.seek(0, 2)
    end, out = file.tell(), []

    def at(place: int, length: int) -> bytes:
        file.seek(place)
        return file.read(length)

    while end > 0:
        if end >= 4 and at(end - 4, 4) == b"\0\0\0\0":  # padding between streams
            end -= 4
            continue
        foot = at(end - FOOTER, FOOTER) if end >= 2 * FOOTER else b""
        if foot[10:] != END_MAGIC:
            raise lzma.LZMAError("no end of an xz stream where one should be")
        length = (struct.unpack("<I", foot[4:8])[0] + 1) * 4
        index = at(end - FOOTER - length, length)
        records, place = varint(index, 1)
        sizes = []
        for _ in range(records):
            packed, place = varint(index, place)
            size, place = varint(index, place)
            sizes.append((packed, size))
        start = end - FOOTER - length - sum(-(-packed // 4) * 4 for packed, _ in sizes)
        end = start - HEADER
        if end < 0 or at(end, len(MAGIC)) != MAGIC:
            raise lzma.LZMAError("no start of an xz stream where one should be")
        found = []
        for packed, size in sizes:
            found.append(Block(start, packed, size, foot[8:10]))
            start += -(-packed // 4) * 4
        out = found + out
    return out


def decoded(file: IO[bytes], block: Block) -> Iterator[bytes]:
    """The bytes of a block: behind a header of its stream's kind it begins a stream, and a decoder needs no more."""
    import zlib

    decoder = lzma.LZMADecompressor(lzma.FORMAT_XZ)
    decoder.decompress(MAGIC + block.flags + struct.pack("<I", zlib.crc32(block.flags)))
    file.seek(block.start)
    left, made = block.length, 0
    while left > 0 or not decoder.needs_input and made < block.size:
        data = b""
        if decoder.needs_input:
            data = file.read(min(PIECE, left))
            if not data:
                break
            left -= len(data)
        plain = decoder.decompress(data, PIECE)
        made += len(plain)
        if plain:
            yield plain
    if made != block.size:
        raise lzma.LZMAError(f"a block gave {made} bytes and not {block.size}")


def ranges(file: IO[bytes], most: int) -> list[tuple[int, int]]:
    """First block and the block behind the last of parts of about `most` compressed bytes."""
    out, begin, held = [], 0, 0
    every = blocks(file)
    for k, block in enumerate(every):
        if held and held + block.length > most:
            out.append((begin, k))
            begin, held = k, 0
        held += block.length
    return [*out, (begin, len(every))] if every else []


def records(file: IO[bytes], first: int, behind: int, begins: re.Pattern[bytes], ends: bytes) -> Iterator[bytes]:
    """Records that begin in the blocks from first to behind, whole, whichever block they end in."""
    every = blocks(file)
    own = sum(b.size for b in every[first:behind])  # bytes in which this part's records begin
    stream = (data for b in every[first:] for data in decoded(file, b))
    held, base = b"", 0  # bytes at hand, and the place of the first of them
    while True:
        m = begins.search(held)
        if m and base + m.start() >= own or not m and base + len(held) >= own + 64:
            return
        if not m:
            keep = max(0, len(held) - 64)  # a mark may be cut
            held, base = held[keep:], base + keep
        else:
            end = held.find(ends, m.end())
            if end >= 0:
                yield held[m.start() : end + len(ends)]
                held, base = held[end + len(ends) :], base + end + len(ends)
                continue
        parts, size = [], 0
        while size < max(PIECE, len(held)):  # twice as much each time, so that a long record is searched a few times only
            data = next(stream, None)
            if data is None:
                break
            parts.append(data)
            size += len(data)
        if not parts:
            return
        held += b"".join(parts)
