"""Secrets by assignment-aware lexing.

Fixed patterns find the plain forms. Besides, source and configuration text is
lexed into pairs of a name and a literal, in the assignment forms of usual
languages and formats; names stand for the literals last given to them, so
joined and passed-on values are resolved; and a literal is scored by how
sensitive its target's name is and how random it looks.
"""

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tracemill.llm.common import covered, overlaps, pieces, table, text_of

KINDS = ("assign", "access", "hex", "literal")

# The base patterns.
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
# In lower case, one of these stands in every match of ASSIGN.
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Parts of names and how sensitive they are.
SENSITIVE = {
    "password": 3, "passwd": 3, "pwd": 3, "pass": 2, "passphrase": 3, "secret": 3, "token": 3, "apikey": 3, "credential": 3,
    "credentials": 3, "private": 2, "signing": 2, "encryption": 2, "auth": 2, "bearer": 3, "access": 1, "api": 1, "key": 1,
    "client": 1, "salt": 1, "session": 1, "cookie": 1, "webhook": 1, "dsn": 2, "jwt": 3,
}
# A pair is reported from this score on: sensitivity of the name, at least 2, and randomness of the literal.
MIN_SENSITIVITY, MIN_SCORE, MIN_LITERAL = 2, 4.0, 6
# Parts a value takes over from names: a name that doubles itself from line to line would grow without end.
MAX_PARTS = 1000
# Whole literals that stand for a value to be filled in.
PLACEHOLDER = re.compile(
    r"(?is)(x{3,}|\*{2,}|\.{3,}|<.*>|\$?\{.*\}"
    r"|(?=.*(?:change_?me|your|example|dummy|placeholder|none|null|true|false|test|todo))(?:(?:my|your|the|an?|some|insert|enter|change_?me|change|example|dummy|sample|placeholder|none|null|true|false|test|todo|here|value"
    r"|pass|password|passwd|pwd|secret|token|key|api|private|access|auth|user|name|client|id)[\W_]*)+)"
)

LEX = re.compile(
    r"(?P<long>\"\"\"(?s:.*?)\"\"\"|\'\'\'(?s:.*?)\'\'\')"
    r"|(?P<string>\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*')"
    r"|(?P<ref>\$\{[A-Za-z_]\w*\}|\$[A-Za-z_]\w*|%\([A-Za-z_]\w*\)s)"
    r"|(?P<op>:=|=>|[=!<>]=|=|:)"
    r"|(?P<name>[A-Za-z_][\w.-]*)"
    r"|(?P<value>[0-9][\w+/.=-]*)"
    r"|(?P<join>[+&]|\.\.)"
    r"|(?P<open>[\[\](){}])"
    r"|(?P<other>[^\s])"
)
ASSIGNMENTS = {"=", ":=", "=>", ":"}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The plain forms: (kind, start, end), by start and then kind."""
    out = []
    lower = text.lower()
    if any(name in lower for name in _NAMES):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def sensitivity(name: str) -> int:
    """How sensitive a name's parts are, joined parts such as api_key included."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", name)]
    joined = [a + b for a, b in zip(parts, parts[1:])]
    return sum(SENSITIVE.get(p, 0) for p in parts + joined)


def randomness(literal: str) -> float:
    """Bits a character by the literal's own frequencies, with a grain for mixed kinds of characters."""
    n = len(literal)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    kinds = sum(bool(re.search(k, literal)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return bits / 2 + (kinds - 1) / 2


class Value:
    """A resolved literal: where its parts stand in the source, and whether it is a bare word."""

    def __init__(self, source: str, spans: list, bare: bool = False):
        self.source, self.spans, self.bare = source, spans, bare

    @property
    def text(self) -> str:
        return "".join(self.source[a:b] for a, b in self.spans)


def pairs(text: str) -> Iterator[tuple[str, Value]]:
    """Names with the literals assigned to them, in order of the text.

    A right side is a run of literals and known names joined by an operator or
    standing side by side, or a bare word. It may begin on a line after its
    name and go on over line ends: in three quotes, behind a backslash or an
    operator, in open brackets, or indented below the name as a block. Names
    keep their last value.
    """
    known: dict[str, Value] = {}
    at = 0
    while at < len(text):
        stop = _line_end(text, at)
        if text.find("=", at, stop) >= 0 or text.find(":", at, stop) >= 0:
            at = yield from _line_pairs(text, at, stop, known)
        else:
            at = stop + 1


def _line_end(text: str, at: int) -> int:
    stop = text.find("\n", at)
    return len(text) if stop < 0 else stop


def _lexed(text: str, at: int, stop: int) -> tuple[list, int]:
    """The tokens of a line and where it ends; one in three quotes takes the line to its own end."""
    tokens = []
    while True:
        for m in LEX.finditer(text, at, stop):
            if m.lastgroup == "string" and m[0] in ('""', "''") and text.startswith(m[0][0], m.end()):
                whole = LEX.match(text, m.start())
                if whole.lastgroup == "long":
                    tokens.append(("string", whole[0][2:-2], whole.start() + 2, whole.end() - 2))
                    at = whole.end()
                    stop = max(stop, _line_end(text, at))
                    break
            if m.lastgroup == "long":
                tokens.append(("string", m[0][2:-2], m.start() + 2, m.end() - 2))
            else:
                tokens.append((m.lastgroup, m[0], m.start(), m.end()))
        else:
            return tokens, stop


def _indent(text: str, at: int) -> int:
    return len(re.compile(r"[ \t]*").match(text, at)[0])


class _Open:
    """An assignment that may go on over line ends: where its operator stands and how deep its round brackets are."""

    def __init__(self, tokens: list):
        ops = [i for i, t in enumerate(tokens) if t[0] == "op" and t[1] in ASSIGNMENTS]
        self.op = ops[-1] if ops else None
        self.depth = 0
        if ops:
            self.add(tokens[self.op + 1 :])

    def add(self, tokens: list) -> None:
        self.depth += sum((t[1] == "(") - (t[1] == ")") for t in tokens)

    def goes_on(self, text: str, at: int, tokens: list, stop: int) -> bool:
        """Whether the assignment takes its value, or more of it, from the next line."""
        if not tokens or stop >= len(text) or self.op is None:
            return False
        kind, word = tokens[-1][:2]
        if kind == "join" or kind == "other" and word == "\\" or kind == "open" and word == "(" or self.depth > 0:
            return True
        # Nothing, or the sign of a block, behind the operator: an indented line below is the value.
        right = [t[1] for t in tokens[self.op + 1 : self.op + 4]]
        if not right and word != ":" or right in ([], ["|"], [">"], ["|", "-"], [">", "-"]):
            return _indent(text, stop + 1) > _indent(text, at) or word in ("=", ":=", "=>")
        return False


def _line_pairs(text: str, at: int, stop: int, known: dict[str, Value]) -> Iterator[tuple[str, Value]]:
    """The pairs of the line at `at` and of those it goes on over; returns where the next line begins."""
    start, first_stop, (tokens, stop) = at, stop, _lexed(text, at, stop)
    # What stands in three quotes may hold pairs itself.
    again = first_stop if stop > first_stop else None
    open_ = _Open(tokens)
    while open_.goes_on(text, start, tokens, stop):
        more, after = _lexed(text, stop + 1, _line_end(text, stop + 1))
        if any(t[0] == "op" and t[1] in ASSIGNMENTS for t in more):
            # The next line has a name of its own.
            break
        while tokens[-1][0] == "other" and tokens[-1][1] in "\\|>" or tokens[-1][1] == "-" and tokens[-2][1] in "|>":
            tokens.pop()
        tokens += more
        open_.add(more)
        stop = after
        if not more:
            break
    for i, (kind, op, _, _) in enumerate(tokens):
        if kind != "op" or op not in ASSIGNMENTS or not i:
            continue
        name = _target(tokens, i)
        if not name:
            continue
        value = _right_side(text, tokens, i + 1, known)
        if value is not None:
            known[name] = value
            yield name, value
    return (stop if again is None else again) + 1


def _target(tokens: list, i: int) -> str | None:
    """The name before an operator: a word, a quoted key, or the key in brackets."""
    kind, word, start, end = tokens[i - 1]
    if kind == "open" and word == "]" and i > 2:
        kind, word, start, end = tokens[i - 2]
    if kind == "string" and re.fullmatch(r"[A-Za-z_][\w.-]*", word[1:-1]):
        return word[1:-1]
    return word if kind == "name" else None


def _right_side(text: str, tokens: list, i: int, known: dict[str, Value]) -> Value | None:
    """The value behind an operator; names add up to `MAX_PARTS` parts of what they stand for."""
    parts, bare, expect, passed_on = None, True, True, 0
    while i < len(tokens):
        kind, word, start, end = tokens[i]
        if kind == "join":
            expect = True
        elif kind == "string":
            parts = parts or []
            parts.append((start + 1, end - 1))
            bare, expect = bare and end - start == 2, False
        elif kind == "ref" or kind == "name" and word in known:
            found = known.get(re.sub(r"\W", "", word[:-1] if kind == "ref" and word.endswith(")s") else word) if kind == "ref" else word)
            if found is None or not expect or passed_on + len(found.spans) > MAX_PARTS:
                break
            passed_on += len(found.spans)
            parts = (parts or []) + found.spans
            bare, expect = bare and found.bare, False
        elif kind in ("name", "value") and parts is None:
            # A bare word goes on to the next blank or closing sign.
            while i + 1 < len(tokens) and tokens[i + 1][2] == end and tokens[i + 1][1] not in ",;)]}":
                i, end = i + 1, tokens[i + 1][3]
            return Value(text, [(start, end)], True)
        elif kind == "open" and word == "(" and parts is None:
            pass
        else:
            break
        i += 1
    return None if parts is None else Value(text, parts, bare)


def literal_spans(text: str) -> list[tuple[str, int, int]]:
    """Literals given to sensitive names, each part of a joined literal for itself."""
    out = set()
    for name, value in pairs(text):
        weight = sensitivity(name)
        if weight < MIN_SENSITIVITY:
            continue
        whole = value.text
        if len(whole) < MIN_LITERAL or PLACEHOLDER.fullmatch(whole.strip()):
            continue
        # A bare word must hold more than letters, else prose after a colon would count.
        if value.bare and (" " in whole or not re.search("[0-9]", whole)):
            continue
        if weight + randomness(whole) >= MIN_SCORE:
            out.update(("literal", a, b) for a, b in value.spans if b > a)
    return sorted(out, key=lambda s: s[1:])


def all_spans(text: str) -> tuple[list, list]:
    """Base spans, and all spans: those of the lexer join where they overlap no base span."""
    base = base_spans(text)
    more = []
    if "=" in text or ":" in text:
        taken = covered(base)
        more = [s for s in literal_spans(text) if not overlaps(taken, s[1], s[2])]
    return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts and digest of the base spans, and all spans.

    Offsets are code points, ends exclusive. Null and empty texts have no
    spans; repeated rows and null ids give a row each; a text is scanned whole.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    counted = KINDS[:3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            counts, digests, spans = [], [], []
            for text in batch.column("text").to_pylist():
                base, found = all_spans(text)
                n = Counter(s[0] for s in base)
                counts.append([n[k] for k in counted])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(found))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in counted], "base_sha256", "spans"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return rows.mapInArrow(run, schema)


def op7_assignment_secrets(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
