"""Opening one packed file. Small per-row helpers for the unpack stage."""

import bz2
import gzip
import io
import lzma
import tarfile
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from typing import BinaryIO

# What a row can hold, with some room for its other columns.
ROW_LIMIT = 2**31 - 2**20
TAR_BLOCK = 512
CHUNK = 1 << 20


@dataclass(frozen=True)
class Limits:
    """How members are taken out.

    A member of more than `row_bytes` is written as a file below the shared
    folder `spill`; without one it stays packed and is reported. So is a member
    that grows by more than `ratio`, a guard against hostile archives.
    """

    row_bytes: int = ROW_LIMIT
    ratio: float | None = None
    spill: str | None = None


class Refused(Exception):
    """A guard stopped this member."""


class Long:
    """A member too long for a row, still to be read in chunks."""

    def __init__(self, chunks: Iterable[bytes]):
        self.chunks = chunks


def bounded(chunks: Iterable[bytes], packed_bytes: int | None, limits: Limits) -> Iterator[bytes]:
    size, bound = 0, None
    if limits.ratio is not None and packed_bytes is not None:
        bound = int(limits.ratio * max(packed_bytes, 1))
    for chunk in chunks:
        size += len(chunk)
        if bound is not None and size > bound:
            raise Refused(f"output exceeds {bound} bytes")
        yield chunk


def _read(stream, packed_bytes: int | None, limits: Limits, head: bytes = b"") -> bytes | Long:
    """What is left of a stream, behind the `head` already read from it."""
    parts, size = [], 0
    chunks = bounded(chain([head] if head else [], iter(lambda: stream.read(CHUNK), b"")), packed_bytes, limits)
    for chunk in chunks:
        parts.append(chunk)
        size += len(chunk)
        if size > limits.row_bytes:
            return Long(chain(parts, chunks))
    return b"".join(parts)


class Metered:
    """A stream that refuses to give more than the ratio allows for its packed size."""

    def __init__(self, stream, packed_bytes: int, limits: Limits):
        self.stream, self.left = stream, None
        if limits.ratio is not None:
            self.bound = self.left = int(limits.ratio * max(packed_bytes, 1))

    def read(self, size: int = -1) -> bytes:
        chunk = self.stream.read(size)
        if self.left is not None:
            self.left -= len(chunk)
            if self.left < 0:
                raise Refused(f"output exceeds {self.bound} bytes")
        return chunk


def free_name(name: str, taken: set[str]) -> str:
    """The name, or the first of name#1, name#2, ... that isn't taken yet; it is taken then."""
    free, n = name, 0
    while free in taken:
        n += 1
        free = f"{name}#{n}"
    taken.add(free)
    return free


def _exactly(size: int, chunks: Iterable[bytes]) -> Iterator[bytes]:
    for chunk in chunks:
        size -= len(chunk)
        yield chunk
    if size:
        raise EOFError("member is cut off")


def _safe(name: str) -> bool:
    return bool(name) and not name.startswith("/") and ".." not in name.split("/")


Outcome = tuple[str | None, bytes | Long | None, str | None]


def open_zip(content: bytes, limits: Limits) -> Iterator[Outcome]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for info in archive.infolist():
            if info.is_dir():
                continue
            if not _safe(info.filename):
                yield None, None, f"unsafe member name {info.filename!r}"
                continue
            try:
                member = archive.open(info)
                data = _read(member, info.compress_size, limits)
            except Exception as exc:
                yield None, None, f"unreadable member {info.filename!r}: {exc}"
                continue
            yield info.filename, data, None
            member.close()


def open_tar(stream, limits: Limits) -> Iterator[Outcome]:
    with tarfile.open(fileobj=stream, mode="r|") as archive:
        for info in archive:
            if info.isdir():
                continue
            if not info.isfile():
                yield None, None, f"member {info.name!r} is not a regular file"
                continue
            if not _safe(info.name):
                yield None, None, f"unsafe member name {info.name!r}"
                continue
            data = _read(archive.extractfile(info), None, limits)
            if isinstance(data, Long):
                data = Long(_exactly(info.size, data.chunks))
            elif len(data) < info.size:
                raise EOFError(f"member {info.name!r} is cut off")
            yield info.name, data, None


def _stream(kind: str, raw: BinaryIO):
    if kind == "gzip":
        return gzip.GzipFile(fileobj=raw)
    if kind == "bzip2":
        return bz2.BZ2File(raw)
    return lzma.LZMAFile(raw)


def is_tar(head: bytes) -> bool:
    return head[257:262] == b"ustar"


def open_stream(kind: str, raw: BinaryIO, packed_bytes: int, limits: Limits) -> Iterator[Outcome]:
    """A compressed stream: its members if a tar archive is inside, else its one file, named ''."""
    with _stream(kind, raw) as stream:
        head = stream.read(TAR_BLOCK)
        if not is_tar(head):
            yield "", _read(stream, packed_bytes, limits, head), None
            return
    raw.seek(0)
    with _stream(kind, raw) as stream:
        yield from open_tar(Metered(stream, packed_bytes, limits), limits)


def open_packed(kind: str, content: bytes, limits: Limits) -> Iterator[Outcome]:
    """Outcomes `(member, bytes, warning)` of one packed file; damage ends it with a warning."""
    try:
        if kind == "zip":
            yield from open_zip(content, limits)
        elif kind == "tar":
            yield from open_tar(io.BytesIO(content), limits)
        else:
            yield from open_stream(kind, io.BytesIO(content), len(content), limits)
    except Exception as exc:
        yield None, None, f"damaged {kind} file: {exc or type(exc).__name__}"
