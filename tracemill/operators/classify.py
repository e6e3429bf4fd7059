"""Signature matching and the fan-out of files to extractors."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tracemill.operators.registry import ALWAYS, UNREADABLE, Extractor, Signature, with_signature, without_signature
from tracemill.sources.files import read_range

# Signatures compared one by one in a projection.
MAX_INLINE = 200
# Bits that test keys before the join against a longer table.
FILTER_MAPS, FILTER_BITS = 64, 32_768


def _names(names: Iterable[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def _matches(content: Column, signature: Signature) -> Column:
    magic = F.lit(signature.magic)
    if signature.offset == 0:
        return F.startswith(content, magic)
    return read_range(content, signature.offset, len(signature.magic)) == magic


def signature_parsers(registry: Iterable[Extractor], content: Column | None = None) -> Column:
    """Names of the extractors whose signature the content carries, each once.

    A handful of comparisons in one projection: nothing is joined or shuffled,
    and the two branches of the fan-out share the one read of the file.
    """
    content = F.col("content") if content is None else content
    hits = []
    for extractor in with_signature(registry):
        hit = reduce(lambda a, b: a | b, [_matches(content, s) for s in extractor.signatures])
        hits.append(F.when(hit, _names([extractor.name])).otherwise(_names([])))
    return F.concat(*hits) if hits else _names([])


def signature_ranges(registry: Iterable[Extractor]) -> list[tuple[int, int]]:
    """Where signatures stand, as `(offset, size)`."""
    return sorted({(s.offset, len(s.magic)) for e in with_signature(registry) for s in e.signatures})


def parsers_by_parts(registry: Iterable[Extractor], parts: Column) -> Column:
    """As `signature_parsers`, from the bytes at `signature_ranges` alone."""
    place = {r: k for k, r in enumerate(signature_ranges(registry))}
    hits = []
    for extractor in with_signature(registry):
        found = [F.get(parts, F.lit(place[s.offset, len(s.magic)])) == F.lit(s.magic) for s in extractor.signatures]
        hit = F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in found]), F.lit(False))
        hits.append(F.when(hit, _names([extractor.name])).otherwise(_names([])))
    return F.concat(*hits) if hits else _names([])


def classify(files: DataFrame, registry: Iterable[Extractor]) -> DataFrame:
    """Add `sig_parsers`, the candidate extractors by signature."""
    return files.withColumn("sig_parsers", signature_parsers(registry))


def signature_match(files: DataFrame, registry: Iterable[Extractor]) -> DataFrame:
    """One row per file and matching extractor."""
    return files.select("path", F.explode(signature_parsers(registry)).alias("parser"))


def _may_match(signatures: DataFrame):
    """A test of a key `(offset, magic)` that passes every signature and few others: one bit a key's hash.

    The bits are as many however long the table, `FILTER_MAPS` maps of 32,768,
    and are part of the plan.
    """
    hashed = F.xxhash64(F.col("offset").cast("int"), "magic")
    place = lambda h: (F.pmod(h, F.lit(FILTER_MAPS)), F.pmod(F.shiftrightunsigned(h, 32), F.lit(FILTER_BITS)))
    number, position = place(hashed)
    maps = signatures.groupBy(number.cast("int").alias("number")).agg(F.bitmap_construct_agg(position).alias("bits"))
    held = {r["number"]: bytes(r["bits"]) for r in maps.collect()}
    bits = F.array(*[F.lit(held.get(n, bytes(FILTER_BITS // 8))) for n in range(FILTER_MAPS)])

    def test(key: Column) -> Column:
        number, position = place(F.xxhash64(key["offset"].cast("int"), key["magic"]))
        start = (F.shiftright(position, 3) + 1).cast("int")
        byte = F.conv(F.hex(F.substr(F.get(bits, number.cast("int")), start, F.lit(1))), 16, 10).cast("int")
        return F.call_function("getbit", byte, (position % 8).cast("int")) == 1

    return test


def signature_match_table(files: DataFrame, signatures: DataFrame, max_inline: int = MAX_INLINE) -> DataFrame:
    """Signature matching against a table `(parser, magic, offset)` instead of a registry.

    One row per file row and matching extractor, at every length of the table. A
    table of at most `max_inline` rows becomes comparisons in a projection. A
    longer one is met in an equi-join: each file gives one key per distinct
    (offset, length) that passes a bit test made from the table, so about as
    many rows enter the join as come out of it.
    """
    rows = signatures.select("parser", "magic", "offset").limit(max_inline + 1).collect()
    if len(rows) <= max_inline:
        by_parser: dict[str, list[Signature]] = {}
        for row in rows:
            by_parser.setdefault(row["parser"], []).append(Signature(bytes(row["magic"]), row["offset"]))
        return signature_match(files, [Extractor(name, tuple(marks)) for name, marks in by_parser.items()])

    probes = signature_probes(files, signatures)
    return probes.join(signatures, ["offset", "magic"]).select("file", "path", "parser").distinct().drop("file")


def signature_probes(files: DataFrame, signatures: DataFrame) -> DataFrame:
    """(file, path, offset, magic): of each file the bytes that may be a signature; `file` numbers the rows."""
    sized = signatures.withColumn("size", F.octet_length("magic"))
    # Positions, not signatures: however long the table, they are few, and one array holds them.
    shapes = sized.select("offset", "size").distinct().orderBy("offset", "size").collect()
    places = F.array(*[F.struct(F.lit(s["offset"]).alias("offset"), F.lit(s["size"]).alias("size")) for s in shapes])
    content, may = F.col("content"), _may_match(signatures)

    def key(place: Column) -> Column:
        offset, size = place["offset"].cast("int"), place["size"].cast("int")
        start = F.when(offset >= 0, offset + 1).otherwise(offset)
        return F.struct(place["offset"].alias("offset"), F.substr(content, start, size).alias("magic"))

    keys = F.filter(F.transform(places, key), may)
    # Numbered before a row becomes several.
    numbered = files.select("path", "content", F.monotonically_increasing_id().alias("file"))
    return numbered.select("file", "path", F.inline(keys))


def has_signature(registry: Iterable[Extractor]) -> Column:
    return F.size(signature_parsers(registry)) > 0


def assigned_parsers(registry: Iterable[Extractor], sig: Column) -> Column:
    """All extractors of a file: its matches, or else every one without a
    signature, and always the forced one."""
    nonsig = _names(e.name for e in without_signature(registry))
    return F.array_union(F.when(F.size(sig) == 0, nonsig).otherwise(sig), _names([ALWAYS]))


def assign_nonsig(files: DataFrame, registry: Iterable[Extractor]) -> DataFrame:
    """The signature-less extractors given to each file without a match."""
    registry = tuple(registry)
    names = _names(e.name for e in without_signature(registry))
    return files.where(~has_signature(registry)).select("path", F.explode(names).alias("parser"))


def work_items(files: DataFrame, registry: Iterable[Extractor], *keep: str) -> DataFrame:
    """One row per file and assigned extractor, with the columns named in `keep`."""
    registry = tuple(registry)
    parsers = assigned_parsers(registry, F.col("sig_parsers"))
    if UNREADABLE in registry:
        unread = F.isnull("content") & (F.col("length") > 0)
        parsers = F.when(unread, _names([UNREADABLE.name, ALWAYS])).otherwise(parsers)
    return classify(files, registry).select("path", *keep, F.explode(parsers).alias("parser"))
