"""Content of files too long for a row, read in splits as an automaton.

What an extractor wants to know of a whole file is stated as facts: how often a
literal occurs, whether it does, what first stands between two literals on a
line, or the members of a JSON object. Each split is read by a task of its own,
which doesn't know in what state the file is where it begins: inside a string
or not, behind an opening literal or not. So it says for each state it may
begin in what it would find and in which state it would end. One short row a
split is then composed in order, and that gives every split its state and the
file its facts. Occurrences belong to the split they begin in.
"""

import re
from collections.abc import Iterable, Iterator, Mapping
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tracemill.operators.registry import Between, Count, Has, LongForm
from tracemill.session import spool
from tracemill.sources import lines
from tracemill.sources.files import MAX_CONTENT_BYTES
from tracemill.sources.listing import FLUSH_BYTES, open_uri, task_count

# Members of a JSON object that make one result row, in bytes of the file.
ROW_BYTES = 256 << 20
CHUNK = 1 << 20

FILE = "uri STRING, path STRING, name STRING, length BIGINT, mtime TIMESTAMP_NTZ"
FILE_NAMES = ["uri", "path", "name", "length", "mtime"]

# What ends a line for a dot in a pattern.
LINE_END = re.compile(rb"\n|\r|\xc2\x85|\xe2\x80[\xa8\xa9]")


def splits_of(files: DataFrame, split_bytes: int) -> DataFrame:
    """(uri, path, name, length, mtime, start, stop) of listed files, as many tasks as their bytes call for."""
    size = F.lit(split_bytes).cast("bigint")
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), size))
    found = files.select(*FILE_NAMES, start.alias("start"))
    found = spool(found.withColumn("stop", F.least(F.col("length"), F.col("start") + size)), "content-splits")
    return found.repartition(lines.tasks_for(found))


def _count(data: bytes, n: int, literal: bytes) -> int:
    """Occurrences that begin in the first n bytes, none overlapping the one before within the data."""
    return data.count(literal, 0, n + len(literal) - 1)


def between(data: bytes, n: int, fact: Between) -> dict:
    """What a split finds of `open ... close` on a line, by whether it begins behind an open one.

    `found` is the first whole match of a split begun with none open, `open` the
    one left open at its end. `closes` ends a match begun before; where it is
    none, `ends_line` says whether that match is given up, and then the same
    holds from the first line end on as in `found` and `open`, given apart as
    they may lie before it.
    """

    def scan(at: int) -> tuple[tuple[int, int] | None, int | None]:
        close = -1
        while 0 <= (begin := data.find(fact.open, at)) < n:
            inner = begin + len(fact.open)
            if close < inner:
                close = data.find(fact.close, inner)
                close = close if 0 <= close < n else n
            end = LINE_END.search(data, inner)
            line = end.start() if end and end.start() < n else n
            if close < line:
                return (inner, close), None
            if line == n:
                return None, inner
            at = line
        return None, None

    first = LINE_END.search(data)
    line = first.start() if first and first.start() < n else None
    close = data.find(fact.close)
    close = close if 0 <= close < (n if line is None else line) else None
    found, left = scan(0)
    after, left_after = scan(line) if line is not None else (None, None)
    return {
        "found": found, "open": left, "closes": close, "ends_line": line is not None, "after": after, "open_after": left_after,
    }


_PAIR = pa.list_(pa.int64())
_BETWEEN = pa.struct([
    ("found", _PAIR), ("open", pa.int64()), ("closes", pa.int64()), ("ends_line", pa.bool_()), ("after", _PAIR), ("open_after", pa.int64()),
])
_BETWEEN_SQL = (
    "STRUCT<found: ARRAY<BIGINT>, open: BIGINT, closes: BIGINT, ends_line: BOOLEAN, after: ARRAY<BIGINT>, open_after: BIGINT>"
)


def first_between(found: Iterable[dict]) -> tuple[int, int] | None:
    """The first match of a file from what its splits found, in order."""
    begun = None
    for split in found:
        if begun is None:
            match, begun = split["found"], split["open"]
        elif split["closes"] is not None:
            return begun, split["closes"]
        elif not split["ends_line"]:
            continue
        else:
            match, begun = split["after"], split["open_after"]
        if match:
            return tuple(match)
    return None


def _read(raw: BinaryIO, start: int, stop: int) -> bytes:
    raw.seek(start)
    return raw.read(stop - start)


def literal_facts(files: DataFrame, facts: Mapping[str, Count | Has | Between], split_bytes: int) -> DataFrame:
    """Listed files with one column a fact: one read of every file, in splits."""
    names = list(facts)
    literals = [x for f in facts.values() for x in ((f.open, f.close) if isinstance(f, Between) else (f.literal,))]
    # So far behind a split whatever begins in it may reach.
    reach = max(len(x) for x in [*literals, b"\xe2\x80\xa8"]) - 1
    kinds = {n: _BETWEEN if isinstance(f, Between) else pa.int64() for n, f in facts.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: [] for name in names}
            for uri, start, stop in zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "stop"))):
                with open_uri(uri) as raw:
                    data = _read(raw, start, stop + reach)
                for name, fact in facts.items():
                    if not isinstance(fact, Between):
                        columns[name].append(_count(data, stop - start, fact.literal))
                        continue
                    found = between(data, stop - start, fact)
                    shift = lambda x: None if x is None else [start + y for y in x] if isinstance(x, tuple) else start + x
                    columns[name].append({k: v if k == "ends_line" else shift(v) for k, v in found.items()})
            for name in names:
                batch = batch.append_column(f"_{name}", pa.array(columns[name], kinds[name]))
            yield batch

    sql = ", ".join(f"_{n} {_BETWEEN_SQL if isinstance(f, Between) else 'BIGINT'}" for n, f in facts.items())
    scanned = spool(splits_of(files, split_bytes).mapInArrow(scan, f"{FILE}, start BIGINT, stop BIGINT, {sql}"), "facts-by-split")

    def fact_of(uri: str, fact: Count | Has | Between, found: list):
        if not isinstance(fact, Between):
            return sum(found) > 0 if isinstance(fact, Has) else sum(found)
        place = first_between(found)
        if not place or place[1] - place[0] > MAX_CONTENT_BYTES:
            return ""
        with open_uri(uri) as raw:
            return _read(raw, *place).decode("utf-8", "replace")

    types = [pa.string() if isinstance(f, Between) else pa.bool_() if isinstance(f, Has) else pa.int64() for f in facts.values()]

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(batch, first, rows):
            own = [batch.column(c).slice(first, len(rows)) for c in FILE_NAMES]
            return pa.RecordBatch.from_arrays([*own, *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], [*FILE_NAMES, *names])

        for batch in batches:
            first, rows, size = 0, [], 0
            for uri, splits in zip(batch.column("uri").to_pylist(), batch.column("splits")):
                splits = splits.as_py()
                row = [fact_of(uri, fact, [s[f"_{name}"] for s in splits]) for name, fact in facts.items()]
                text = sum(len(x) for x in row if isinstance(x, str))
                if rows and size + text > FLUSH_BYTES:
                    yield packed(batch, first, rows)
                    first, rows, size = first + len(rows), [], 0
                rows.append(row)
                size += text
            if rows:
                yield packed(batch, first, rows)

    result = ", ".join(f"{n} {'STRING' if isinstance(f, Between) else 'BOOLEAN' if isinstance(f, Has) else 'BIGINT'}" for n, f in facts.items())
    in_order = F.array_sort(F.collect_list(F.struct("start", *[f"_{n}" for n in names]))).alias("splits")
    # Short rows, but each stands for a file to open: their tasks are stated, or all would be put together in one.
    by_file = scanned.repartition(lines.tasks_for(scanned), "path").groupBy(*FILE_NAMES).agg(in_order)
    return spool(by_file.mapInArrow(compose, f"{FILE}, {result}"), "facts")


# JSON: a split may begin inside a string or outside of one.

_ESCAPE = re.compile(rb"\\[\s\S]")


def _escaped(raw: BinaryIO, start: int) -> bool:
    """Whether an odd number of backslashes stands right before `start`."""
    at, n = start, 0
    while at:
        back = _read(raw, max(0, at - CHUNK), at)
        kept = len(back.rstrip(b"\\"))
        n += len(back) - kept
        if kept:
            break
        at -= len(back)
    return n % 2 == 1


def _chunks(raw: BinaryIO, start: int, stop: int) -> Iterator[tuple[int, np.ndarray]]:
    """(position, bytes) of a split in chunks, escaped characters blanked out."""
    carry = _escaped(raw, start)
    for at in range(start, stop, CHUNK):
        data = _read(raw, at, min(at + CHUNK, stop))
        if carry:
            data = b" " + data[1:]
        data = _ESCAPE.sub(b"  ", data)
        carry = data.endswith(b"\\")
        yield at, np.frombuffer(data[:-1] + b" " if carry else data, np.uint8)


def _levels(data: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte whether it stands outside of strings, and how it changes the depth if so."""
    quoted = np.bitwise_xor.accumulate((data == 34).view(np.uint8)) ^ inside
    change = ((data == 123) | (data == 91)).astype(np.int8) - ((data == 125) | (data == 93)).astype(np.int8)
    return quoted == 0, change


def _json_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split whether it changes between inside and outside, and by state the depth it adds and its least."""
    for batch in batches:
        rows = []
        for uri, start, stop in zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "stop"))):
            flips, depth, least = 0, [0, 0], [0, 0]
            with open_uri(uri) as raw:
                for _, data in _chunks(raw, start, stop):
                    outside, change = _levels(data, flips)
                    for state, mask in ((0, outside), (1, ~outside)):
                        steps = np.cumsum(np.where(mask, change, 0), dtype=np.int64)
                        least[state] = min(least[state], depth[state] + int(steps.min()))
                        depth[state] += int(steps[-1])
                    flips ^= int(np.count_nonzero(data == 34)) & 1
            rows.append((flips, *depth, *least))
        for k, name in enumerate(("flips", "depth0", "depth1", "least0", "least1")):
            batch = batch.append_column(name, pa.array([r[k] for r in rows], pa.int64()))
        yield batch


def _json_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split the first comma between members of the object, and where the object ends, if they are in it."""
    for batch in batches:
        cuts, ends = [], []
        names = ("uri", "start", "stop", "inside", "depth", "ends")
        for uri, start, stop, inside, depth, has_end in zip(*(batch.column(c).to_pylist() for c in names)):
            cut = end = None
            with open_uri(uri) as raw:
                for at, data in _chunks(raw, start, stop):
                    outside, change = _levels(data, inside)
                    level = depth + np.cumsum(np.where(outside, change, 0), dtype=np.int64)
                    if has_end:
                        closed = np.flatnonzero((level <= 0) & outside & (change < 0))
                        end = at + int(closed[0]) if len(closed) else None
                    if cut is None:
                        commas = np.flatnonzero((data == 44) & outside & (level == 1))
                        if len(commas) and (end is None or at + int(commas[0]) < end):
                            cut = at + int(commas[0])
                    if end is not None or cut is not None and not has_end:
                        break
                    inside ^= int(np.count_nonzero(data == 34)) & 1
                    depth = int(level[-1])
            cuts.append(cut)
            ends.append(end)
        yield batch.append_column("cut", pa.array(cuts, pa.int64())).append_column("end", pa.array(ends, pa.int64()))


def json_members(files: DataFrame, name: str, split_bytes: int) -> DataFrame:
    """Listed files with the members of their one JSON object as text in `name`, in rows numbered by `part`.

    A file is cut at commas between members, one a split at most, and its pieces
    put together to rows of about `ROW_BYTES` of the file, each an object of its
    own. A file that isn't one object from its first byte on has null in its
    one row.
    """
    splits = spool(splits_of(files, split_bytes).mapInArrow(
        _json_states, f"{FILE}, start BIGINT, stop BIGINT, flips BIGINT, depth0 BIGINT, depth1 BIGINT, least0 BIGINT, least1 BIGINT"
    ), "json-states")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2).cast("int")
    by_state = lambda c: F.when(F.col("inside") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1"))
    known = splits.withColumn("inside", inside).withColumn("adds", by_state("depth")).withColumn("least", by_state("least"))
    known = known.withColumn("depth", F.coalesce(F.sum("adds").over(before), F.lit(0)))
    # The object ends in the first split that gets down to depth 0; the first one begins there and is looked through.
    ends = (F.col("start") == 0) | (F.col("depth") + F.col("least") <= 0)
    known = known.select(*FILE_NAMES, "start", "stop", "inside", "depth", ends.alias("ends"))
    over = F.coalesce(F.max(F.col("ends") & (F.col("start") > 0)).over(before), F.lit(False))
    live = spool(known.withColumn("over", over).where("NOT over").drop("over"), "json-known")
    found = live.repartition(lines.tasks_for(live)).mapInArrow(
        _json_cuts, f"{FILE}, start BIGINT, stop BIGINT, inside INT, depth BIGINT, ends BOOLEAN, cut BIGINT, end BIGINT"
    )
    found = spool(found.select(*FILE_NAMES, "start", "cut", "end"), "json-cuts")
    whole = found.groupBy("path").agg(F.min("end").alias("last"))
    # Pieces begin behind the opening bracket and behind each cut.
    begins = F.when(F.col("start") == 0, F.array_compact(F.array(F.lit(0).cast("bigint"), "cut"))).otherwise(F.array_compact(F.array("cut")))
    places = found.join(whole, "path").select(*FILE_NAMES, "last", F.explode(begins).alias("at"))
    places = places.where(F.col("last").isNull() | (F.col("at") < F.col("last")))
    follows = F.lead("at").over(Window.partitionBy("path").orderBy("at"))
    pieces = places.withColumn("to", F.coalesce(follows, F.col("last")))
    pieces = pieces.withColumn("size", F.greatest(F.col("to") - F.col("at") - 1, F.lit(0)))
    pieces = spool(pieces, "json-pieces")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("uri", "at", "to", "size")))
            first, texts, held = 0, [], 0
            for uri, at, to, size in rows:
                text = None
                if to is not None and size <= MAX_CONTENT_BYTES:
                    with open_uri(uri) as raw:
                        text = _read(raw, at + 1, to)
                # A batch is sent before a row that would make it too long.
                if texts and held + len(text or b"") > FLUSH_BYTES:
                    yield batch.slice(first, len(texts)).append_column("text", pa.array(texts, pa.binary()))
                    first, texts, held = first + len(texts), [], 0
                texts.append(text)
                held += len(text or b"")
            if texts:
                yield batch.slice(first, len(texts)).append_column("text", pa.array(texts, pa.binary()))

    cost = pieces.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).first()
    tasks = task_count(pieces.sparkSession, cost["bytes"], cost["n"])
    texts = pieces.repartition(tasks).mapInArrow(read, f"{FILE}, last BIGINT, at BIGINT, to BIGINT, size BIGINT, text BINARY")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda p: p["text"].cast("string"))
    rows = texts.groupBy(*FILE_NAMES, F.col("last").isNotNull().alias("closed"), F.floor(F.col("at") / ROW_BYTES).alias("part")).agg(
        in_order.alias("pieces"), F.count("*").alias("n"), F.count("text").alias("read")
    )
    # A blank piece beside others is a comma too many.
    blank = (F.col("n") > 1) & F.exists("pieces", lambda p: F.trim(p) == "")
    text = F.when(F.col("closed") & (F.col("read") == F.col("n")) & ~blank, F.concat(F.lit("{"), F.array_join("pieces", ","), F.lit("}")))
    rows = rows.select(*FILE_NAMES, F.dense_rank().over(Window.partitionBy("path").orderBy("part")).alias("nth"), text.alias(name))
    return rows.withColumn("part", (F.col("nth") - 1).cast("bigint")).drop("nth")


def long_items(files: DataFrame, form: LongForm, split_bytes: int = lines.SPLIT_BYTES) -> DataFrame:
    """Listed files with the columns a form's emits refer to and `part`, the number of the row among the file's."""
    if form.members is not None:
        return json_members(files, form.members, split_bytes)
    return literal_facts(files, form.facts, split_bytes).withColumn("part", F.lit(0).cast("bigint"))
