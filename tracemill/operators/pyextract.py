"""Extractors written in Python, run over Arrow batches with failures isolated."""

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, BinaryIO

import pyarrow as pa

from tracemill.schemas import EVENT_DATA, EXTRACTION_ERROR, EXTRACTION_WARNING, RECOVERY_WARNING

FLUSH_ROWS = 5000

_TIME = pa.struct([("timestamp_desc", pa.string()), ("timestamp", pa.timestamp("us"))])
RESULT_TYPES = {
    "container": pa.string(),
    "path": pa.string(),
    "parser": pa.string(),
    "seq": pa.int64(),
    "message": pa.string(),
    "attributes": pa.map_(pa.string(), pa.string()),
    "times": pa.list_(_TIME),
}


@dataclass
class FileRow:
    path: str
    name: str
    length: int
    mtime: Any
    content: bytes | None
    uri: str | None = None

    def open(self) -> BinaryIO:
        """The content as a file to seek in, wherever it is held."""
        if self.content is None and self.uri is not None:
            from tracemill.sources.listing import open_uri

            return open_uri(self.uri)
        return io.BytesIO(self.content or b"")


class Emitter:
    """What a Python extractor uses to make result rows.

    The extractor is a generator taking the emitter; it yields what the methods
    below return. Rows yielded before an exception are kept.
    """

    def __init__(self, file: FileRow, parser: str):
        self.file = file
        self._chain = [parser]
        self._seq = 0

    def push(self, name: str) -> None:
        self._chain.append(name)

    def pop(self) -> None:
        self._chain.pop()

    @property
    def chain(self) -> str:
        return "/".join(self._chain)

    def _row(self, container, message=None, attributes=None, times=None, seq=None):
        if seq is None:
            seq = self._seq
        self._seq = seq + 1
        return (
            container, self.file.path, self.chain, seq, message,
            [(str(k), None if v is None else str(v)) for k, v in (attributes or {}).items()],
            [{"timestamp_desc": desc, "timestamp": at} for desc, at in (times or {}).items()],
        )

    def event(self, attributes=None, times=None, seq=None):
        return self._row(EVENT_DATA, attributes=attributes, times=times, seq=seq)

    def extraction_warning(self, message, seq=None):
        return self._row(EXTRACTION_WARNING, message, seq=seq)

    def recovery_warning(self, message, seq=None):
        return self._row(RECOVERY_WARNING, message, seq=seq)

    def error(self, exc: Exception):
        return self._row(EXTRACTION_ERROR, f"{type(exc).__name__}: {exc}")


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in RESULT_TYPES]
    arrays = [pa.array(list(c), t) for c, t in zip(columns, RESULT_TYPES.values())]
    return pa.RecordBatch.from_arrays(arrays, list(RESULT_TYPES))


def checked(row: tuple) -> tuple:
    """The row, if each of its values has its column's type; else an error, raised where the row was made."""
    for value, kind in zip(row, RESULT_TYPES.values(), strict=True):
        pa.array([value], kind)
    return row


class _Pending:
    """Rows waiting to be sent, by the work item that made them.

    Values are checked for a whole batch at once; only where that fails are
    they looked at row by row, to keep what came before the bad one.
    """

    def __init__(self):
        self.items: list[tuple[Emitter, list[tuple]]] = []
        self.rows = 0

    def begin(self, emitter: Emitter) -> None:
        self.items.append((emitter, []))

    def add(self, row: tuple) -> None:
        self.items[-1][1].append(row)
        self.rows += 1

    def _good(self, emitter: Emitter, rows: list[tuple]) -> tuple[list[tuple], bool]:
        """The rows up to the first bad one, with its error in its place, and whether there was one."""
        try:
            _to_batch(rows)
            return rows, False
        except Exception:
            for k, row in enumerate(rows):
                try:
                    checked(row)
                except Exception as exc:
                    # The error's number follows the bad row's, as if raised there.
                    emitter._seq = row[3] + 1
                    return [*rows[:k], emitter.error(exc)], True
            raise

    def flush(self) -> tuple[pa.RecordBatch, bool]:
        """All rows as a batch, and whether the last item had a bad one and so is done with."""
        items, self.items, self.rows = self.items, self.items[-1:], 0
        self.items = [(emitter, []) for emitter, _ in self.items]
        try:
            return _to_batch([row for _, rows in items for row in rows]), False
        except Exception:
            good = [self._good(emitter, rows) for emitter, rows in items]
            return _to_batch([row for rows, _ in good for row in rows]), good[-1][1]


def run_python(functions: dict[str, Callable]) -> Callable:
    """A batch function that runs the extractor each work item names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = _Pending()
        for batch in batches:
            columns = [batch.column(c) for c in batch.schema.names]
            names = batch.schema.names
            for i in range(batch.num_rows):
                values = {name: column[i].as_py() for name, column in zip(names, columns)}
                parser = values.pop("parser")
                emitter = Emitter(FileRow(**values), parser)
                pending.begin(emitter)
                try:
                    for row in functions[parser](emitter):
                        pending.add(row)
                        if pending.rows >= FLUSH_ROWS:
                            sent, failed = pending.flush()
                            yield sent
                            if failed:
                                break
                except GeneratorExit:
                    raise
                except Exception as exc:
                    pending.add(emitter.error(exc))
        if pending.rows:
            yield pending.flush()[0]

    return run
