"""Blocks of compressed streams: where they lie, and decoding one by itself.

A bzip2 stream is a row of blocks that begin with a mark at any bit; an xz
stream lists its blocks at its end. A block is decoded by wrapping it as a
stream of its own, checksums included, so a long stream can be read by many
tasks. A mark found in compressed data by chance shows as a block that can't be
decoded, and is then taken as part of the block before.
"""

import bz2
import lzma
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np

# The marks of a bzip2 block and of the end of a stream.
BLOCK_MARK, END_MARK = 0x314159265359, 0x177245385090
MARK_BITS, CRC_BITS = 48, 32
# Header and footer of an xz stream.
XZ_HEADER, XZ_FOOTER, XZ_END = 12, 12, b"YZ"


def _patterns(mark: int) -> list[tuple[int, bytes]]:
    """For each bit a mark may begin at in a byte, the five whole bytes that follow this one."""
    return [(shift, (mark << (8 - shift)).to_bytes(7, "big")[1:6]) for shift in range(8)]


def marks(data: bytes, mark: int) -> list[int]:
    """Bit positions at which the mark begins in the data."""
    found = []
    for shift, middle in _patterns(mark):
        at = data.find(middle)
        while at >= 0:
            # The mark begins in the byte before its whole bytes.
            begin = (at - 1) * 8 + shift
            if begin >= 0 and bits_at(data, begin, MARK_BITS) == mark:
                found.append(begin)
            at = data.find(middle, at + 1)
    return sorted(found)


def bits_at(data: bytes, begin: int, n: int) -> int | None:
    """The number in n bits from a bit position on."""
    first, last = begin // 8, -(-(begin + n) // 8)
    if last > len(data):
        return None
    return int.from_bytes(data[first:last], "big") >> (last * 8 - begin - n) & (1 << n) - 1


def find_marks(raw: BinaryIO, start: int, stop: int) -> list[tuple[int, bool]]:
    """(bit position, whether a block begins) of the marks that begin in bytes [start, stop) of a bzip2 file."""
    raw.seek(start)
    data = raw.read(stop - start + 7)
    limit = (stop - start) * 8
    found = [(p, True) for p in marks(data, BLOCK_MARK)] + [(p, False) for p in marks(data, END_MARK)]
    return sorted((start * 8 + p, block) for p, block in found if p < limit)


def bzip2_block(raw: BinaryIO, begin: int, end: int) -> bytes:
    """The content of the block in bits [begin, end) of a file."""
    first, last = begin // 8, -(-end // 8)
    raw.seek(first)
    data = np.frombuffer(raw.read(last - first + 1) + b"\0", np.uint8)
    shift, n = begin - first * 8, end - begin
    if shift:
        data = (data[:-1] << shift) | (data[1:] >> (8 - shift))
    whole, rest = divmod(n, 8)
    body = data[:whole].tobytes()
    # The end of a stream of one block: its mark and the block's own checksum.
    crc = int.from_bytes(body[6:10], "big")
    tail = (END_MARK << CRC_BITS) | crc
    tail |= int(data[whole] >> (8 - rest)) << (MARK_BITS + CRC_BITS) if rest else 0
    bits = MARK_BITS + CRC_BITS + rest
    pad = -bits % 8
    return bz2.decompress(b"BZh9" + body + (tail << pad).to_bytes((bits + pad) // 8, "big"))


def bzip2_run(raw: BinaryIO, begins: list[int], ends: list[int]) -> Iterator[bytes]:
    """The contents of blocks that follow each other, by where they may begin and end.

    `ends` has the end of each and then those of later ones, for a block that
    a chance mark cuts.
    """
    k = 0
    while k < len(begins):
        error, last = None, k
        for last in range(k, len(ends)):
            try:
                yield bzip2_block(raw, begins[k], ends[last])
                break
            except (OSError, ValueError, EOFError) as exc:
                error = error or exc
                if last - k >= 3:
                    raise ValueError(f"damaged bzip2 block: {error}") from error
        else:
            raise ValueError(f"damaged bzip2 block: {error}")
        k = last + 1


def _number(data: bytes, at: int) -> tuple[int, int]:
    """A number in seven bits a byte, and where it ends."""
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _coded(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def xz_blocks(raw: BinaryIO, length: int) -> list[tuple[int, int, int, int]]:
    """(stream start, block start, unpadded size, content size) of all blocks of an xz file, in order.

    Read from the indexes at the ends of its streams, the last stream first.
    """
    found, end = [], length
    while end > 0:
        raw.seek(end - 4)
        if raw.read(4) == b"\0\0\0\0":
            end -= 4
            continue
        raw.seek(end - XZ_FOOTER)
        footer = raw.read(XZ_FOOTER)
        if footer[-2:] != XZ_END or zlib.crc32(footer[4:10]) != int.from_bytes(footer[:4], "little"):
            raise ValueError("damaged xz footer")
        size = (int.from_bytes(footer[4:8], "little") + 1) * 4
        raw.seek(end - XZ_FOOTER - size)
        index = raw.read(size)
        if zlib.crc32(index[:-4]) != int.from_bytes(index[-4:], "little"):
            raise ValueError("damaged xz index")
        n, at = _number(index, 1)
        sizes = []
        for _ in range(n):
            unpadded, at = _number(index, at)
            content, at = _number(index, at)
            sizes.append((unpadded, content))
        held = sum(-(-unpadded // 4) * 4 for unpadded, _ in sizes)
        start = end - XZ_FOOTER - size - held - XZ_HEADER
        if start < 0:
            raise ValueError("damaged xz index")
        at, blocks = start + XZ_HEADER, []
        for unpadded, content in sizes:
            blocks.append((start, at, unpadded, content))
            at += -(-unpadded // 4) * 4
        found = blocks + found
        end = start
    return found


def xz_block(raw: BinaryIO, stream: int, at: int, unpadded: int, content: int) -> bytes:
    """The content of one block, as a stream of its own: the stream's header, the block, an index of it."""
    raw.seek(stream)
    header = raw.read(XZ_HEADER)
    raw.seek(at)
    block = raw.read(-(-unpadded // 4) * 4)
    index = b"\0" + _coded(1) + _coded(unpadded) + _coded(content)
    index += b"\0" * (-len(index) % 4)
    index += zlib.crc32(index).to_bytes(4, "little")
    fields = (len(index) // 4 - 1).to_bytes(4, "little") + header[6:8]
    return lzma.decompress(header + block + index + zlib.crc32(fields).to_bytes(4, "little") + fields + XZ_END)
