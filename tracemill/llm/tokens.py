"""Token ids as binary files.

Texts are encoded with a public tokenizer, ids are renumbered by falling
frequency over the corpus, and the ranks are written in a byte-aligned code
with its control bytes apart: two control bits a value give its length of one
to four bytes. Files are Parquet tables sorted by document, so the control and
the data bytes of many documents stand together in column chunks and a reader
may skip either. Decoding looks lengths and masks up in numpy tables.
"""

import gc
import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tracemill.llm.common import pieces, table, text_of
from tracemill.session import shared_dir, spool

END_ID = 2
TOKENIZER = "word_bpe_49k.json"
# Chunks of text whose ids one task keeps at a time.
CACHE_CHUNKS = 700_000
# Tokens of one file, about.
FILE_TOKENS = 16_000_000

# A word of Latin letters and the marks after it. The tokenizer parts them, and
# for these letters its lower case is Python's, so both parts are encoded alone.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
WORD = re.compile("[a-zß-öø-ÿ]+")

# Control byte to the lengths of its four values, and length to the bits that count.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.int64)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def offsets_of(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def binary_array(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive pieces of `data` as an Arrow array of binaries."""
    ends = offsets_of(counts).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())]
    )


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all binaries one after the other, and how many each has."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8)
    return flat, np.diff(ends).astype(np.int64)


def encode_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes, data bytes and how many of either each document has.

    `ranks` holds the documents' values one after the other. Each document's
    control bytes begin anew, so it can be decoded alone.
    """
    ranks = ranks.astype("<u4")
    length = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    n_control = (counts + 3) // 4
    slot = np.arange(len(ranks)) + np.repeat(4 * offsets_of(n_control)[:-1] - offsets_of(counts)[:-1], counts)
    codes = np.zeros(4 * int(n_control.sum()), np.uint8)
    codes[slot] = length - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < length[:, None]]
    ends = offsets_of(length)
    n_data = np.diff(ends[offsets_of(counts)])
    return control, data, n_control, n_data


def decode_ranks(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The values of documents encoded by `encode_ranks`."""
    n_control = (counts + 3) // 4
    slot = np.arange(int(counts.sum())) + np.repeat(4 * offsets_of(n_control)[:-1] - offsets_of(counts)[:-1], counts)
    length = LENGTHS[control].reshape(-1)[slot]
    at = offsets_of(length)[:-1]
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    values = padded[at] | padded[at + 1] << 8 | padded[at + 2] << 16 | padded[at + 3] << 24
    return values & MASKS[length]


def lower_latin(text: str) -> str:
    """The text in lower case if it is all Latin-1, where Python's and the tokenizer's agree; else as it is.

    A text that may hold the name of a special token, whose case counts, stays.
    """
    if "<|" in text:
        return text
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


class Numbers(dict):
    """Numbers strings in the order they are first seen."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, string: str) -> int:
        number = self[string] = len(self)
        self.new.append(string)
        return number


class Runs:
    """Numbered runs of ids, one after the other in a pool."""

    def __init__(self):
        self.ids, self.starts, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + offsets_of(counts)[:-1]])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these runs, and how many each has."""
        counts = self.counts[numbers]
        ends = offsets_of(counts)
        return self.ids[np.arange(ends[-1]) + np.repeat(self.starts[numbers] - ends[:-1], counts)], counts


class Encoder:
    """Encodes texts chunk by chunk, each distinct chunk once.

    The tokenizer treats white space as a border that it drops, so the ids of
    a text are those of its chunks between blanks and line ends. A chunk that
    is a word of Latin letters with marks behind it is two parts, of which the
    word is encoded in lower case, once for all its forms.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        by_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: by_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError("ids of this tokenizer need more than 16 bits")
        self.clear()

    def clear(self) -> None:
        self.chunks, self.chunk_runs = Numbers(), Runs()
        self.parts, self.part_runs = Numbers(), Runs()

    def learn(self) -> None:
        """Encode the chunks first seen since the last call."""
        number, both = self.parts.__getitem__, []
        for chunk in self.chunks.new:
            match = PLAIN.fullmatch(chunk)
            both += (number(match[1].lower()), number(match[2])) if match else (number(chunk), number(""))
        self.chunks.new.clear()
        # Parts are numbered anew by how they are encoded, then looked up by their first number.
        new = self.parts.new
        plain = [bool(WORD.fullmatch(p)) for p in new]
        self.part_runs.add(*self.encode_words([p for p, w in zip(new, plain) if w]))
        self.part_runs.add(*self.encode_others([p for p, w in zip(new, plain) if not w]))
        first = len(self.part_runs.counts) - len(new)
        order = np.argsort(~np.array(plain, bool), kind="stable")
        for column in (self.part_runs.starts, self.part_runs.counts):
            column[first + order] = column[first:].copy()
        self.parts.new.clear()
        ids, counts = self.part_runs.take(np.array(both, np.int64))
        self.chunk_runs.add(ids, counts.reshape(-1, 2).sum(axis=1))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words as the merging model takes them: each of their bytes a letter."""
        merge, letters = self.tokenizer.model.tokenize, self.letters
        encoded = [[t.id for t in merge(w if w.isascii() else w.translate(letters))] for w in words]
        return np.fromiter(itertools.chain.from_iterable(encoded), np.uint32), np.fromiter(map(len, encoded), np.int64)

    def encode_others(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        return np.fromiter(itertools.chain.from_iterable(encoded), np.uint32), np.fromiter(map(len, encoded), np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, an end id after each, and their counts."""
        if len(self.chunks) > CACHE_CHUNKS:
            self.clear()
        number = self.chunks.__getitem__
        numbers, n_chunks = [], []
        for text in texts:
            chunks = lower_latin(text).replace("\n", " ").split(" ")
            numbers += map(number, chunks)
            n_chunks.append(len(chunks))
        if self.chunks.new:
            self.learn()
        ids, length = self.chunk_runs.take(np.array(numbers, np.int64))
        ends = offsets_of(length)
        counts = np.diff(ends[offsets_of(np.array(n_chunks, np.int64))])
        with_end = np.full(len(ids) + len(texts), END_ID, np.uint32)
        with_end[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), counts)] = ids
        return with_end, counts + 1


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of each text as little-endian 16-bit integers, the end id last; null texts as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        gc.disable()  # many strings and numbers are made and none of them in cycles
        for batch in pieces(batches):
            ids, counts = encoder.encode(batch.column(1).to_pylist())
            packed = binary_array(ids.astype("<u2").view(np.uint8), 2 * counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary")


def frequencies(tokens: DataFrame) -> DataFrame:
    """How often each id occurs; a task sends one row per id at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in pieces(batches):
            ids = flat_bytes(batch.column(0))[0].view("<u2")
            more = np.bincount(ids, minlength=len(counts))
            more[: len(counts)] += counts
            counts = more
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts[ids])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(tokens: DataFrame, folder: str) -> None:
    """Write `tokens` (doc_id, ids of 16 bits) below `folder` in ascending order of doc_id.

    They are read twice, so they are computed once, into a table.

    `codebook` has the ids by rank, `ids` the documents: file number, ids
    before the document within its file, count, control bytes, data bytes;
    `files` has how many ids stand before each file. Nulls come first; among
    equal ids the order is that of a hash of the ids, so runs agree.
    """
    spark = tokens.sparkSession
    tokens = spool(tokens, "token-ids", compression="zstd")
    # One row per id of the vocabulary: its size is the bound.
    known = frequencies(tokens).orderBy(F.desc("n"), "id").toPandas()
    codebook = known["id"].to_numpy(np.int64)
    rank_of = np.zeros(int(codebook.max(initial=0)) + 1, np.uint32)
    rank_of[codebook] = np.arange(len(codebook), dtype=np.uint32)
    ranked = spark.createDataFrame([(r, int(i)) for r, i in enumerate(codebook)], "rank long, id long")
    ranked.coalesce(1).write.parquet(f"{folder}/codebook")
    n_files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(known["n"].sum()) // FILE_TOKENS + 1)
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in pieces(batches):
            ids, n_bytes = flat_bytes(batch.column("ids"))
            counts = n_bytes // 2
            control, data, n_control, n_data = encode_ranks(rank_of[ids.view("<u2")], counts)
            starts = before + offsets_of(counts)
            before = int(starts[-1])
            columns = [
                pa.array(np.full(len(counts), part, np.int32)),
                batch.column("doc_id"),
                pa.array(starts[:-1]),
                pa.array(counts),
                binary_array(control, n_control),
                binary_array(data, n_data),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "doc_id", "local_start", "n_tokens", "control", "data"])

    rows = tokens.withColumn("tie", F.xxhash64("ids"))
    dealt = rows.repartitionByRange(n_files, F.col("doc_id").asc_nulls_first(), "tie")
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "ids").select("doc_id", "ids")
    schema = f"file int, doc_id {kind}, local_start long, n_tokens long, control binary, data binary"
    dealt.mapInArrow(run, schema).write.option("compression", "zstd").parquet(f"{folder}/ids")
    sizes = spark.read.parquet(f"{folder}/ids").groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()
    starts = offsets_of(np.array([r["n"] for r in sizes], np.int64))
    files = spark.createDataFrame([(r["file"], int(s)) for r, s in zip(sizes, starts)], "file int, start long")
    files.coalesce(1).write.parquet(f"{folder}/files")


def read_tokens(spark, folder: str, summary: bool = False) -> DataFrame:
    """The documents of `write_tokens`: doc_id, start, n_tokens and ids (array<long>), or ids_crc32 for `summary`.

    The codebook has a row per id of the vocabulary and `files` one per file;
    both are small enough for every task.
    """
    codebook = spark.read.parquet(f"{folder}/codebook").orderBy("rank").toPandas()["id"].to_numpy(np.uint32)
    starts = {r["file"]: r["start"] for r in spark.read.parquet(f"{folder}/files").collect()}
    rows = spark.read.parquet(f"{folder}/ids")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            counts = batch.column("n_tokens").to_numpy()
            control, data = (flat_bytes(batch.column(c))[0] for c in ("control", "data"))
            ids = codebook[decode_ranks(control, data, counts)].astype("<u4")
            ends = offsets_of(counts)
            base = np.fromiter(map(starts.__getitem__, batch.column("file").to_pylist()), np.int64, len(counts))
            if summary:
                raw = memoryview(ids.view(np.uint8))
                out = pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])], pa.int64())
            else:
                out = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base + batch.column("local_start").to_numpy()), batch.column("n_tokens"), out],
                names=["doc_id", "start", "n_tokens", "out"],
            )

    name, out = ("ids_crc32", "long") if summary else ("ids", "array<long>")
    schema = f"doc_id {kind}, start long, n_tokens long, out {out}"
    return rows.mapInArrow(run, schema).withColumnRenamed("out", name)


def op8_token_output(spark, sf_dir):
    import public_tokenizers

    folder = shared_dir(spark, "token-files")
    write_tokens(tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)), folder)
    return read_tokens(spark, folder, summary=True)
