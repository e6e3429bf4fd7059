"""Sampled SentencePiece segmentations by forward filtering and backward sampling.

A text is a run of units, each a blank and what follows it up to the next blank
or line end. No piece crosses a unit, so each distinct unit has one lattice of
pieces: filtering forward gives every node its probability, and a segmentation
is sampled backward from the end, for all units of many texts at a time. The
random numbers are a hash of the row's key, the unit's place and the step, so a
row has the same segmentation in any run and on any machine. Characters without
a piece become bytes; decoding gives back every text exactly.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tracemill.llm.common import pieces as cut, table, text_of

MODEL = "piece_bpe_32k.model"
# Exponent of a piece's probability: larger sticks to frequent pieces, 0 treats all alike.
SHARPNESS = 1.0
# Pieces the model marks as never to be formed have scores below this.
UNUSED_SCORE = -1e8
# Units whose lattice one task keeps at a time.
CACHE_UNITS = 100_000
# Bytes of texts sampled at a time: arrays of a number a step of each unit take some 100 times as much.
TEXT_BYTES = 1 << 18
# Random numbers of a step are below this.
DRAWS = 1 << 32

_STEP = np.uint64(0x9E3779B97F4A7C15)
# Upper bits of a hash by which beginnings of pieces are known.
PREFIX_BITS = 18
_PREFIX = np.uint64(64 - PREFIX_BITS)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gathered(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Runs of `flat` one after the other, each `count` long from `first` on."""
    ends = np.cumsum(count)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)]


class Vocabulary:
    """Pieces as hashes by length, with log probabilities, and the bytes of every id.

    The model is of the merging kind and knows ranks only. A piece of rank r
    has a probability in proportion to 1 / (r + 2), Zipf's law.
    """

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_file)
        self.size = model.get_piece_size()
        self.byte_ids: dict[int, int] = {}
        self.bytes_of: list[bytes] = []
        by_length: dict[int, list[tuple[str, int, float]]] = {}
        for i in range(self.size):
            piece, score = model.id_to_piece(i), model.get_score(i)
            raw = b""
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], raw = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i)):
                text = piece.replace("▁", " ")
                raw = text.encode()
                if score > UNUSED_SCORE:
                    by_length.setdefault(len(text), []).append((text, i, -SHARPNESS * math.log(2 - score)))
            self.bytes_of.append(raw)
        self.raw = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.n_raw = np.array([len(raw) for raw in self.bytes_of], np.int64)
        self.first_raw = np.cumsum(self.n_raw) - self.n_raw
        # By length: sorted hashes, then ids, log probabilities and characters in that order.
        self.tables = {}
        # By length: whether a longer piece may begin with characters of such a hash, by its upper bits.
        self.begins = {k: np.zeros(1 << PREFIX_BITS, bool) for k in range(1, max(by_length))}
        for length, rows in sorted(by_length.items()):
            chars = np.array([code_points(text) for text, _, _ in rows])
            hashes = np.zeros(len(rows), np.uint64)
            for k in range(length):
                if k:
                    self.begins[k][hashes >> _PREFIX] = True
                hashes = hashes * _STEP + chars[:, k]
            order = np.argsort(hashes)
            ids, log_p = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
            self.tables[length] = hashes[order], ids[order], log_p[order], chars[order]
        self.byte_log_p = -SHARPNESS * math.log(2 + self.size)
        # What an edge emits: a piece, or the bytes of a character without one, numbered after the pieces.
        self.byte_runs: dict[int, int] = {}
        self.emits = [np.array([i], np.int32) for i in range(self.size)]
        self.runs = np.arange(self.size, dtype=np.int32), np.arange(self.size), np.ones(self.size, np.int64)

    def byte_run(self, char: int) -> int:
        """The number of what a character emits as bytes."""
        if char not in self.byte_runs:
            self.byte_runs[char] = len(self.emits)
            raw = chr(char).encode("utf-8", "surrogatepass")
            self.emits.append(np.array([self.byte_ids[x] for x in raw], np.int32))
        return self.byte_runs[char]

    def emitted(self, emits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of what edges emit, one after the other, and how many each has."""
        flat, first, count = self.runs
        if len(first) < len(self.emits):
            new = self.emits[len(first) :]
            more = np.array([len(r) for r in new], np.int64)
            first = np.concatenate([first, len(flat) + np.cumsum(more) - more])
            flat, count = np.concatenate([flat, *new]), np.concatenate([count, more])
            self.runs = flat, first, count
        n_ids = count[emits]
        return gathered(flat, first[emits], n_ids), n_ids

    def edges(self, chars: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All pieces in a row of characters, as (begin, length, what it emits, log probability).

        `room` is how many characters are left from each on before its unit ends.
        """
        at, hashes = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
        found, lone = [], np.ones(len(chars), bool)
        for length in range(1, max(self.tables) + 1):
            here = room[at] >= length
            if length > 1:
                here &= self.begins[length - 1][hashes >> _PREFIX]
            at, hashes = at[here], hashes[here]
            hashes = hashes * _STEP + chars[at + length - 1]
            if length not in self.tables:
                continue
            known, ids, log_p, letters = self.tables[length]
            row = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[row] == hashes
            begin, row = at[hit], row[hit]
            same = (chars[begin[:, None] + np.arange(length)] == letters[row]).all(axis=1)
            begin, row = begin[same], row[same]
            found.append((begin, np.full(len(begin), length), ids[row], log_p[row]))
            if length == 1:
                lone[begin] = False
        begin = np.flatnonzero(lone)
        emits = np.array([self.byte_run(c) for c in chars[begin].tolist()], np.int64)
        n_bytes = np.array([len(self.emits[x]) for x in emits], np.int64)
        found.append((begin, np.ones(len(begin), np.int64), emits, self.byte_log_p * n_bytes))
        return tuple(np.concatenate(x) for x in zip(*found))

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, without the blank that every text is given at its start."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]

    def lossless(self, ids: np.ndarray, counts: np.ndarray, texts: list[str]) -> list[bool]:
        """Whether each text's ids decode to it: all bytes of the ids of many texts are put together at a time."""
        n_bytes = self.n_raw[ids]
        raw = gathered(self.raw, self.first_raw[ids], n_bytes).tobytes()
        upto = np.concatenate([[0], np.cumsum(n_bytes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        wanted = (f" {t}".encode("utf-8", "surrogatepass") if t else b"" for t in texts)
        return [raw[a:b] == w for a, b, w in zip(upto, upto[1:], wanted)]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def filter_forward(depth: np.ndarray, end: np.ndarray, origin: np.ndarray, log_p: np.ndarray, n_nodes: int) -> np.ndarray:
    """The probability of each edge, given that the path passes the node it ends at.

    Edges are filtered by the depth of that node, those of all lattices at a
    time; node numbers begin at 0 and nodes without an edge into them start.
    """
    order = np.argsort(depth * n_nodes + end, kind="stable")
    log_alpha, chance = np.zeros(n_nodes), np.empty(len(end))
    borders = np.flatnonzero(np.diff(depth[order], prepend=-1, append=-1))
    for a, b in zip(borders, borders[1:]):
        edges = order[a:b]
        nodes = end[edges]
        first = np.flatnonzero(np.diff(nodes, prepend=-1))
        count = np.diff(np.append(first, len(nodes)))
        weight = log_alpha[origin[edges]] + log_p[edges]
        top = np.maximum.reduceat(weight, first)
        weight = np.exp(weight - np.repeat(top, count))
        total = np.add.reduceat(weight, first)
        log_alpha[nodes[first]] = top + np.log(total)
        chance[edges] = weight / np.repeat(total, count)
    return chance


class _Numbers(dict):
    """Numbers units in the order they are first seen."""

    def __init__(self, new: list[str], prefix: str):
        self.new, self.prefix = new, prefix
        self.shared: list[int] = []

    def __missing__(self, token: str) -> int:
        self.new.append(self.prefix + token)
        number = self[token] = self.shared[0]
        self.shared[0] += 1
        return number


class Sampler:
    """Lattices of the units seen so far as flat arrays, and sampling from them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.new: list[str] = []
        self.spaced, self.bare = _Numbers(self.new, " "), _Numbers(self.new, "")
        self.spaced.shared = self.bare.shared = [0]
        # Of units: the node at their end. Of nodes: the first of their edges. Of edges: bound (the node, then the border
        # among its draws), origin, what they emit.
        self.end_node = np.empty(0, np.int64)
        self.first_edge = np.zeros(1, np.int64)
        self.bound = np.empty(0, np.int64)
        self.origin = np.empty(0, np.int64)
        self.emits = np.empty(0, np.int32)

    def units(self, text: str) -> list[int]:
        """The numbers of a text's units."""
        if not text:
            return []
        lines = text.split("\n")
        out = list(map(self.spaced.__getitem__, lines[0].split(" ")))
        for line in lines[1:]:
            tokens = line.split(" ")
            out.append(self.bare["\n"])
            if tokens[0]:
                out.append(self.bare[tokens[0]])
            out.extend(map(self.spaced.__getitem__, tokens[1:]))
        return out

    def grow(self) -> None:
        """Add the lattices of new units. A unit of n characters has n + 1 nodes, the first without an edge into it."""
        if not self.new:
            return
        length = np.array([len(u) for u in self.new], np.int64)
        chars = code_points("".join(self.new))
        self.new.clear()
        unit = np.repeat(np.arange(len(length)), length)
        place = np.arange(len(chars)) - np.repeat(np.cumsum(length) - length, length)
        begin, size, emits, log_p = self.vocabulary.edges(chars, length[unit] - place)
        origin = begin + unit[begin]
        end = origin + size
        n_nodes = len(chars) + len(length)
        chance = filter_forward(place[begin] + size, end, origin, log_p, n_nodes)
        order = np.argsort(end, kind="stable")
        n_edges = np.bincount(end, minlength=n_nodes)
        # Each node's borders are summed from 0, its own edges only, so they don't depend on other units.
        last = np.cumsum(n_edges) - 1
        has = n_edges > 0
        upto, nth = chance[order], np.arange(len(order)) - (last - n_edges + 1)[end[order]]
        later = np.flatnonzero(nth)
        for k in range(1, int(n_edges.max(initial=0))):
            this = nth[later] == k
            here, later = later[this], later[~this]
            upto[here] += upto[here - 1]
        node = len(self.first_edge) - 1
        bound = (node + end[order] << 32) + np.minimum(upto * DRAWS, DRAWS - 1).astype(np.int64)
        bound[last[has]] = node + np.flatnonzero(has) + 1 << 32
        self.end_node = np.concatenate([self.end_node, node + np.cumsum(length + 1) - 1])
        self.first_edge = np.concatenate([self.first_edge, self.first_edge[-1] + np.cumsum(n_edges)])
        self.bound = np.concatenate([self.bound, bound])
        self.origin = np.concatenate([self.origin, node + origin[order]])
        self.emits = np.concatenate([self.emits, emits[order].astype(np.int32)])

    def sample(self, keys: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The sampled ids of all texts one after the other, and how many each has."""
        if len(self.end_node) > CACHE_UNITS:
            self.clear()
        per_text = [np.array(self.units(t), np.int64) for t in texts]
        self.grow()
        n_units = np.array([len(u) for u in per_text], np.int64)
        units = np.concatenate(per_text) if per_text else np.empty(0, np.int64)
        seeds = np.array([xxhash.xxh3_64_intdigest(k.encode()) for k in keys], np.uint64)
        place = np.arange(len(units)) - np.repeat(np.cumsum(n_units) - n_units, n_units)
        stream = mix(np.repeat(seeds, n_units) + place.astype(np.uint64) * _STEP)
        node, live = self.end_node[units], np.arange(len(units))
        who, taken, step = [], [], 0
        while True:
            going = self.first_edge[node + 1] > self.first_edge[node]
            live, node = live[going], node[going]
            if not len(live):
                break
            draw = (mix(stream[live] + np.array([step + 1], np.uint64) * _STEP) >> np.uint64(32)).astype(np.int64)
            # From the node's first edge on to the one whose border is beyond the draw: a few steps at most.
            edge, draw = self.first_edge[node], (node << 32) + draw
            short = np.flatnonzero(self.bound[edge] <= draw)
            while len(short):
                edge[short] += 1
                short = short[self.bound[edge[short]] <= draw[short]]
            who.append(live)
            taken.append(edge)
            node, step = self.origin[edge], step + 1
        if not who:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        n_steps = np.zeros(len(units), np.int64)
        for w in who:
            n_steps[w] += 1
        first = np.cumsum(n_steps) - n_steps
        edges = np.empty(int(n_steps.sum()), np.int64)
        for k, (w, e) in enumerate(zip(who, taken)):
            edges[first[w] + n_steps[w] - 1 - k] = e
        ids, n_ids = self.vocabulary.emitted(self.emits[edges])
        upto = np.concatenate([[0], np.cumsum(n_ids)])[np.concatenate([[0], np.cumsum(n_steps)])]
        return ids, np.diff(upto[np.concatenate([[0], np.cumsum(n_units)])])


def encoded(batches: Iterator[pa.RecordBatch], model_file: str) -> Iterator[pa.RecordBatch]:
    """What `encode` gives for batches of doc_id, key and text."""
    vocabulary = Vocabulary(model_file)
    sampler = Sampler(vocabulary)
    for batch in cut(batches, TEXT_BYTES):
        texts = batch.column("text").to_pylist()
        ids, counts = sampler.sample(batch.column("key").to_pylist(), texts)
        ends = np.concatenate([[0], np.cumsum(counts)])
        same = vocabulary.lossless(ids, counts, texts)
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts), lists, pa.array(same)], names=["doc_id", "n_pieces", "ids", "lossless"]
        )


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_pieces, ids, and whether decoding them gave the text back.

    The seed of a row is its id as text, so repeated rows get equal
    segmentations; null ids share one seed. A null text is an empty one, which
    has no pieces. Other columns aren't read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), text_of(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: encoded(batches, model_file), f"doc_id {kind}, n_pieces long, ids array<int>, lossless boolean")


def decode(rows: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) of rows with doc_id and ids; null ids as none."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model_file)
        for batch in cut(batches):
            texts = [vocabulary.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def op3_sampled_pieces(spark, sf_dir):
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
