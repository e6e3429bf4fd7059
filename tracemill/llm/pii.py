"""Personal data by a semi-Markov conditional random field.

Fixed patterns find the plain forms. Besides, a segment model reads the
neighbourhoods of digits and address signs: features of whole spans score every
candidate segment of bounded length, and dynamic programming chooses borders
and types together. It is trained here, on a bounded sample of neighbourhoods
labelled by the plain forms, with written-out and reformatted variants of them,
so it also finds forms the patterns don't know.
"""

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tracemill.llm.common import covered, overlaps, pieces, table, text_of

KINDS = ("email", "ip", "card", "phone")

# The base patterns, written so that no text makes them slow.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Neighbourhoods used for fitting, at most; longer ones aren't used.
MAX_SAMPLE, MAX_SAMPLE_CHARS = 400, 240
# Characters around a trigger that belong to its neighbourhood.
AROUND = 40
# Atoms of the longest segment.
MAX_ATOMS = 24
# First atoms of the segments held at a time.
WINDOW = 2048
# Features are hashed to so many weights.
WEIGHTS = 1 << 14
EPOCHS, RATE, DECAY = 6, 0.3, 1e-3

TRIGGER = re.compile(r"[0-9@]|[(\[{<]\s?(?:at|AT)\s?[)\]}>]|\bdot\b|\bDOT\b")
BLANK = re.compile(r"\s")
ATOM = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with the longest local part before it and a domain behind it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The plain forms: (kind, start, end), by kind and then start."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        octets = (p.lstrip("0") or "0" for p in m[0].split("."))
        if all(len(p) <= 3 and int(p) <= 255 for p in octets):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = only_digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(only_digits(m[0])) <= 15]
    return out


def neighbourhoods(text: str) -> list[tuple[int, int]]:
    """Where triggers stand close together, with what is around them, cut at blanks."""
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    # Out to the blanks around, or to the neighbourhood before, which then goes on in this one.
    merged: list[list[int]] = []
    for a, b in out:
        if not merged or a > merged[-1][1]:
            low = merged[-1][1] if merged else 0
            blank = max((m.end() for m in BLANK.finditer(text, low, a)), default=None)
            a = low if blank is None else blank
        if merged and a <= merged[-1][1]:
            a, b = merged[-1][0], max(b, merged[-1][1])
            if merged.pop()[1] == b:
                # Out to a blank already.
                merged.append([a, b])
                continue
        end = BLANK.search(text, b)
        merged.append([a, end.start() if end else len(text)])
    return [(a, b) for a, b in merged]


def shape(text: str) -> str:
    """Kinds of characters, runs shortened: letters a, digits 9 up to four, the rest as it is."""
    out = re.sub(r"[^\W\d_]+", "a", text)
    out = re.sub(r"[0-9]+", lambda m: "9" * min(4, len(m[0])), out)
    return re.sub(r"\s+", " ", out)


def features(text: str, a: int, b: int) -> list[str]:
    """What is known of the whole span text[a:b] and its borders."""
    span = text[a:b]
    digits = only_digits(span)
    n, low = len(digits), span.lower()
    before, after = text[a - 1 : a], text[b : b + 1]
    kind = lambda c: "edge" if not c else "blank" if c.isspace() else "word" if c.isalnum() else c
    parts = re.split(r"[^0-9]+", span.strip("+()[] "))
    letters = any(c.isalpha() for c in span)
    at = "sign" if "@" in span else "word" if re.search(r"[\s(\[{<]at[\s)\]}>]", low) else "no"
    dot = "sign" if "." in span else "word" if re.search(r"[\s(\[{<]dot[\s)\]}>]", low) else "no"
    out = [
        "bias",
        f"shape {shape(span)[:24]}",
        f"at {at} dot {dot} letters {letters}",
        f"digits {min(n, 20)} letters {letters}",
        f"edges {kind(before)} {kind(after)}",
        f"starts {shape(span[:2])} ends {shape(span[-2:])}",
        f"first {span[0] if not span[0].isalnum() else 'word'} last {span[-1] if not span[-1].isalnum() else 'word'}",
        f"groups {min(len(parts), 6)} plus {span[0] == '+'} letters {letters}",
    ]
    if n >= 13 and not letters:
        out.append(f"luhn {luhn(digits)} plus {span[0] == '+'} length {13 <= n <= 19}")
    if len(parts) == 4 and not letters and all(p for p in parts):
        out.append(f"octets {all(len(p) <= 3 and int(p) <= 255 for p in parts)} dots {dot}")
    if at != "no":
        tail = re.split(r"@|\bat\b", low)[-1].strip(" )]}>")
        out.append(f"domain {bool(re.fullmatch(r'[a-z0-9-]+(?:(?:[.]|[ (\[{<]+dot[ )\]}>]+)[a-z0-9-]+)+', tail))}")
        out.append(f"ats {min(3, len(re.findall('@|[ (]at[ )]', low)))} blanks {min(6, span.count(' '))}")
    return out


def plausible(text: str, a: int, b: int) -> bool:
    """Whether a segment can be an entity at all: a trigger in it, no line end, proper first and last characters."""
    span = text[a:b]
    return (
        "\n" not in span
        and (span[0].isalnum() or span[0] in "+(" and b - a > 1)
        and span[-1].isalnum()
        and TRIGGER.search(span) is not None
    )


class Lattice:
    """The candidate segments of a neighbourhood: atoms from i to j, with hashed features.

    With `first` and `last`, only the segments whose first atom is one of those.
    """

    def __init__(self, text: str, atoms: list[tuple[int, int]] | None = None, first: int = 0, last: int | None = None):
        self.text = text
        self.atoms = [m.span() for m in ATOM.finditer(text)] if atoms is None else atoms
        self.n = len(self.atoms)
        self.segments, hashed = [], []
        for i in range(first, self.n if last is None else min(last, self.n)):
            a = self.atoms[i][0]
            for j in range(i + 1, min(self.n, i + MAX_ATOMS) + 1):
                b = self.atoms[j - 1][1]
                if plausible(text, a, b):
                    self.segments.append((i, j))
                    hashed.append([zlib.crc32(f.encode("utf-8", "surrogatepass")) % WEIGHTS for f in features(text, a, b)])
        width = max(map(len, hashed), default=0)
        # Absent features point at the last weight, which stays 0.
        self.hashed = np.array([h + [WEIGHTS] * (width - len(h)) for h in hashed], np.int64).reshape(len(hashed), width)
    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Of each segment and kind."""
        return weights[self.hashed].sum(axis=1) if len(self.segments) else np.empty((0, len(KINDS)))

    def marginals(self, scores: np.ndarray) -> np.ndarray:
        """The probability of each segment and kind, by sums forward and backward."""
        whole = np.logaddexp.reduce(scores, axis=1) if len(scores) else []
        forward, backward = np.zeros(self.n + 1), np.zeros(self.n + 1)
        starts: list[list[int]] = [[] for _ in range(self.n + 1)]
        into: list[list[int]] = [[] for _ in range(self.n + 1)]
        for k, (i, j) in enumerate(self.segments):
            starts[i].append(k)
            into[j].append(k)
        for j in range(1, self.n + 1):
            terms = [forward[j - 1]] + [forward[self.segments[k][0]] + whole[k] for k in into[j]]
            forward[j] = terms[0] if len(terms) == 1 else np.logaddexp.reduce(terms)
        for i in range(self.n - 1, -1, -1):
            terms = [backward[i + 1]] + [backward[self.segments[k][1]] + whole[k] for k in starts[i]]
            backward[i] = terms[0] if len(terms) == 1 else np.logaddexp.reduce(terms)
        if not len(scores):
            return scores
        i, j = np.array(self.segments).T
        return np.exp(scores + (forward[i] + backward[j] - forward[-1])[:, None])


def best_segments(text: str, weights: np.ndarray) -> list[tuple[str, int, int]]:
    """The best segmentation of a neighbourhood; atoms in no segment score 0. Ties go to fewer segments.

    Segments are built for `WINDOW` first atoms at a time, and the best values
    carried on from window to window: memory grows with the atoms, not with the
    segments, and the outcome is that of one lattice over everything.
    """
    atoms = [m.span() for m in ATOM.finditer(text)]
    n = len(atoms)
    value, through = np.zeros(n + 1), np.full(n + 1, -np.inf)
    begin, kind = np.full(n + 1, -1, np.int64), np.zeros(n + 1, np.int8)
    for start in range(0, n, WINDOW):
        lattice = Lattice(text, atoms, start, start + WINDOW)
        scores = lattice.scores(weights)
        k, top_kind = 0, scores.argmax(axis=1) if len(scores) else []
        for i in range(start, min(n, start + WINDOW)):
            if i:
                value[i] = max(value[i - 1], through[i])
            while k < len(lattice.segments) and lattice.segments[k][0] == i:
                j, v = lattice.segments[k][1], value[i] + scores[k, top_kind[k]]
                if v > through[j]:
                    through[j], begin[j], kind[j] = v, i, top_kind[k]
                k += 1
    out, j = [], n
    if n:
        value[n] = max(value[n - 1], through[n])
    while j > 0:
        if through[j] <= value[j - 1]:
            j -= 1
            continue
        out.append((KINDS[kind[j]], atoms[begin[j]][0], atoms[j - 1][1]))
        j = int(begin[j])
    return out[::-1]


def variants(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The neighbourhood itself, with its spans reformatted, and with their checks broken (then unlabelled)."""

    def rewrite(change) -> tuple[str, list[tuple[str, int, int]]]:
        out, new, at = "", [], 0
        for kind, a, b in sorted(spans, key=lambda s: s[1]):
            word, keep = change(kind, text[a:b])
            out += text[at:a]
            if keep:
                new.append((kind, len(out), len(out) + len(word)))
            out, at = out + word, b
        return out + text[at:], new

    def written(kind, word):
        if kind == "email":
            local, _, domain = re.sub("[0-9]+", "x", word).partition("@")
            return local + " at " + domain.replace(".", " dot "), True
        return (word[1:] if kind == "phone" else word.replace(".", "[.]") if kind == "ip" else word), True

    def bracketed(kind, word):
        if kind == "email":
            return re.sub("[0-9]", "x", word).replace("@", " [at] ").replace(".", " [dot] "), True
        if kind == "phone" and " " in word:
            return word.split(" ", 1)[1], True
        if kind == "card" and len(word) == 16:
            return ".".join(word[k : k + 4] for k in range(0, 16, 4)), True
        return word, True

    def broken(kind, word):
        if kind == "card":
            return word[:-1] + str((int(word[-1]) + 1) % 10), False
        if kind == "ip":
            return "9" + word.replace(".", ".9", 1), False
        return (word.replace("@", " "), False) if kind == "email" else (word[1:8], False)

    return [(text, spans)] + ([rewrite(f) for f in (written, bracketed, broken)] if spans else [])


def train(sample: list[str]) -> np.ndarray:
    """Weights by kind for the labels the plain forms give, by ascent of the conditional likelihood."""
    weights = np.zeros((WEIGHTS + 1, len(KINDS)))
    data = []
    for text in sample:
        spans = [s for s in base_spans(text)]
        disjoint = []
        for s in sorted(spans, key=lambda s: (s[1], -s[2])):
            if not disjoint or s[1] >= disjoint[-1][2]:
                disjoint.append(s)
        for variant, labels in variants(text, disjoint):
            lattice = Lattice(variant)
            at = {(lattice.atoms[i][0], lattice.atoms[j - 1][1]): k for k, (i, j) in enumerate(lattice.segments)}
            gold = [(at[a, b], KINDS.index(kind)) for kind, a, b in labels if (a, b) in at]
            if lattice.segments:
                data.append((lattice, gold))
    step = np.full_like(weights, 1e-6)
    for _ in range(EPOCHS):
        for lattice, gold in data:
            change = -lattice.marginals(lattice.scores(weights))
            for k, kind in gold:
                change[k, kind] += 1
            rows = np.flatnonzero(np.abs(change).max(axis=1) > 1e-4)
            if not len(rows):
                continue
            flat = lattice.hashed[rows].reshape(-1)
            some, place = np.unique(flat, return_inverse=True)
            gradient = np.zeros((len(some), len(KINDS)))
            np.add.at(gradient, place, np.repeat(change[rows], lattice.hashed.shape[1], axis=0))
            gradient -= DECAY * weights[some]
            step[some] += gradient**2
            weights[some] += RATE * gradient / np.sqrt(step[some])
            weights[WEIGHTS] = 0
    return weights


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Weights from a sample of `MAX_SAMPLE` neighbourhoods, three quarters with a plain form in them.

    The sample is that of the lowest hashes, so it doesn't depend on how rows
    are dealt. Without any neighbourhood all weights are 0 and nothing is added.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task sends no more than the whole sample may hold of either sort.
        kept: dict[bool, dict[str, int]] = {True: {}, False: {}}
        for batch in pieces(batches):
            for text in batch.column(0).to_pylist():
                for a, b in neighbourhoods(text):
                    part = text[a:b]
                    if len(part) > MAX_SAMPLE_CHARS:
                        continue
                    own = kept[bool(base_spans(part))]
                    own[part] = zlib.crc32(part.encode("utf-8", "surrogatepass"))
                    if len(own) > 4 * MAX_SAMPLE:
                        for worst in sorted(own, key=lambda p: (own[p], p))[MAX_SAMPLE:]:
                            del own[worst]
        parts = [
            (p, plain) for plain, own in kept.items() for p in sorted(own, key=lambda p: (own[p], p))[:MAX_SAMPLE]
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in parts], pa.string()), pa.array([plain for _, plain in parts], pa.bool_())],
            names=["part", "plain"],
        )

    found = docs.select(text_of(text_col).alias("text")).mapInArrow(run, "part string, plain boolean").distinct()
    sample = []
    for plain, share in ((True, 3), (False, 1)):
        rows = found.filter(F.col("plain") == plain).orderBy(F.crc32(F.col("part").cast("binary")), "part")
        sample += [r["part"] for r in rows.limit(MAX_SAMPLE * share // 4).collect()]
    return train(sample)


def all_spans(text: str, weights: np.ndarray) -> tuple[list, list]:
    """Base spans, and all spans: the model's join where they overlap no base span."""
    base = base_spans(text)
    taken = covered(base)
    more = []
    for a, b in neighbourhoods(text):
        for kind, i, j in best_segments(text[a:b], weights):
            if not overlaps(taken, i + a, j + a):
                more.append((kind, i + a, j + a))
    order = lambda s: (KINDS.index(s[0]), s[1])
    return base, sorted(base + more, key=order)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts and digest of the base spans, and all spans.

    Offsets are code points, ends exclusive. Null and empty texts have no
    spans; repeated rows and null ids give a row each; a text is scanned whole.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            counts, digests, spans = [], [], []
            for text in batch.column("text").to_pylist():
                base, found = all_spans(text, weights)
                n = Counter(s[0] for s in base)
                counts.append([n[k] for k in KINDS])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(found))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def op4_semi_markov_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return scan(docs, fit(docs))
