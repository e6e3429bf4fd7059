"""Extractors: what they match, what they read and what they emit.

An extractor is declared with Spark SQL expressions over the columns `path`,
`name`, `length`, `mtime`, `content`, and, after its content is cut into
records, `seq` and `record`. `:preferred_time_zone`, `:preferred_year` and
`:preferred_codepage` stand for the run's settings. Declared extractors run inside generated code.
An extractor that has to be written in Python gives a generator instead and
runs over Arrow batches.
"""

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from tracemill.schemas import EVENT_DATA, EXTRACTION_WARNING, RECOVERY_WARNING


@dataclass(frozen=True)
class Signature:
    """Bytes expected at an offset; a negative offset counts from the end."""

    magic: bytes
    offset: int = 0


@dataclass(frozen=True)
class Emit:
    """One result row per record for which `when` holds."""

    container: str = EVENT_DATA
    when: str | None = None
    message: str | None = None
    attributes: Mapping[str, str] = field(default_factory=dict)
    times: Mapping[str, str] = field(default_factory=dict)
    # A map expression in place of `attributes`, for keys that only the content knows.
    attribute_map: str | None = None


@dataclass(frozen=True)
class Count:
    """How often a literal occurs, as a long."""

    literal: bytes


@dataclass(frozen=True)
class Has:
    """Whether a literal occurs."""

    literal: bytes


@dataclass(frozen=True)
class Between:
    """What first stands between two literals on one line, as text; empty if nothing does."""

    open: bytes
    close: bytes


@dataclass(frozen=True)
class LongForm:
    """How an extractor reads files too long for a row: facts found in splits, and emits over them.

    Emits refer to the facts by name, or to `members`, the file's JSON object as
    text, in several rows where it is very long.
    """

    emits: tuple[Emit, ...]
    facts: Mapping[str, Count | Has | Between] = field(default_factory=dict)
    members: str | None = None


@dataclass(frozen=True)
class Extractor:
    name: str
    signatures: tuple[Signature, ...] = ()
    emits: tuple[Emit, ...] = ()
    records: str | None = None
    plugin: str | None = None
    needs_content: bool = True
    python: Callable | None = None
    # A Python extractor that reads by `file.open()` and so takes files of any length.
    streams: bool = False
    # Whether expressions that raise give error rows in place of ending the job. To be
    # left on unless none of them can raise: a guarded rule computes its values even
    # where only rows are counted.
    guarded: bool = True
    # For extractors that need the whole content: the same on files too long for a row.
    long: LongForm | None = None

    @property
    def chain(self) -> str:
        return f"{self.name}/{self.plugin}" if self.plugin else self.name


# The extractor every file gets, whatever it matches and whatever is filtered.
ALWAYS = "filestat"

FILESTAT = Extractor(
    ALWAYS,
    needs_content=False,
    guarded=False,
    emits=(Emit(attributes={"size": "CAST(length AS STRING)"}, times={"Modification Time": "mtime"}),),
)

# What a file that was listed but couldn't be read gets besides.
UNREADABLE = Extractor(
    "unreadable",
    needs_content=False,
    guarded=False,
    emits=(Emit(EXTRACTION_WARNING, message="file could not be read"),),
)

HTML = Extractor(
    "html",
    guarded=False,
    signatures=(Signature(b"<!DOCTYPE html"),),
    emits=(
        Emit(attributes={"title": "regexp_extract(CAST(content AS STRING), '<title>(.*?)</title>', 1)"}),
        Emit(
            RECOVERY_WARNING,
            when="NOT contains(CAST(content AS STRING), '</html>')",
            message="unterminated document",
        ),
    ),
    long=LongForm(
        facts={"title": Between(b"<title>", b"</title>"), "closed": Has(b"</html>")},
        emits=(Emit(attributes={"title": "title"}), Emit(RECOVERY_WARNING, when="NOT closed", message="unterminated document")),
    ),
)

MARKUP = Extractor(
    "markup",
    guarded=False,
    signatures=(Signature(b"<"),),
    emits=(
        Emit(
            attributes={
                "tags": "CAST(length(CAST(content AS STRING)) "
                "- length(replace(CAST(content AS STRING), '<', '')) AS STRING)"
            }
        ),
    ),
    long=LongForm(facts={"tags": Count(b"<")}, emits=(Emit(attributes={"tags": "CAST(tags AS STRING)"}),)),
)

JSON = Extractor(
    "json",
    plugin="kv",
    guarded=False,
    signatures=(Signature(b"{"),),
    emits=(
        Emit(
            attribute_map="from_json(CAST(content AS STRING), 'MAP<STRING, STRING>')",
            times={"Modification Time": "mtime"},
        ),
    ),
    long=LongForm(
        members="members",
        emits=(Emit(attribute_map="from_json(members, 'MAP<STRING, STRING>')", times={"Modification Time": "mtime"}),),
    ),
)

LONG_LINE_BYTES = 2000

TEXT = Extractor(
    "text",
    guarded=False,
    # One character a byte, so any content is cut at its line feeds and counted as it is.
    records="split(decode(content, 'ISO-8859-1'), '\\n')",
    emits=(
        Emit(when="record <> ''", attributes={"bytes": "CAST(char_length(record) AS STRING)"}),
        Emit(
            EXTRACTION_WARNING,
            when=f"char_length(record) > {LONG_LINE_BYTES}",
            message=f"line exceeds {LONG_LINE_BYTES} bytes",
        ),
    ),
)

DEFAULT: tuple[Extractor, ...] = (HTML, MARKUP, JSON, TEXT, FILESTAT)


def select_extractors(registry: Iterable[Extractor], expression: str | None) -> tuple[Extractor, ...]:
    """Keep the extractors an expression names: `a,b` only those, `!a` all but it.

    The forced extractor stays whatever the expression says. Choosing here,
    before any plan exists, leaves no filter to run per file.
    """
    registry = tuple(registry)
    terms = [term.strip() for term in (expression or "").split(",") if term.strip()]
    known = {e.name for e in registry}
    unknown = {t.lstrip("!") for t in terms} - known - {"all"}
    if unknown:
        raise ValueError(f"unknown extractors: {', '.join(sorted(unknown))}")
    out = {t[1:] for t in terms if t.startswith("!")}
    wanted = {t for t in terms if not t.startswith("!")}
    if not wanted or "all" in wanted:
        wanted = known
    return tuple(e for e in registry if e.name == ALWAYS or (e.name in wanted and e.name not in out))


def with_signature(registry: Iterable[Extractor]) -> list[Extractor]:
    return [e for e in registry if e.signatures]


def without_signature(registry: Iterable[Extractor]) -> list[Extractor]:
    return [e for e in registry if not e.signatures and e.name != UNREADABLE.name]
