"""Extraction from files too long to be held in one row."""

import re
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracemill.functions.paths import remap_root
from tracemill.operators.classify import parsers_by_parts, signature_ranges
from tracemill.operators.extract import run_extractors
from tracemill.operators.long_content import long_items
from tracemill.operators.registry import Extractor, without_signature
from tracemill.schemas import ATTRIBUTES, EXTRACTION_WARNING, TIMES
from tracemill.sources.files import MAX_CONTENT_BYTES, list_files
from tracemill.session import spool
from tracemill.sources.lines import SPLIT_BYTES, read_lines
from tracemill.sources.listing import read_parts


def root_path(root: str) -> str:
    """The path inside the storage of a folder given by path or URI."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root)


def oversize_results(
    spark: SparkSession,
    root: str,
    registry: Iterable[Extractor],
    max_bytes: int = MAX_CONTENT_BYTES,
    only: DataFrame | None = None,
    listing: DataFrame | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Results of the files under `root` longer than `max_bytes`.

    Metadata extractors see them like any other file. Extractors that cut
    content into lines get the lines, read in splits; those with a form for long
    files get its facts, found in splits; Python extractors that stream open the
    file. Any other one is reported by a warning for each file it was due to read.

    With `only`, just the files of those paths, which are relative to `root`.
    """
    registry = tuple(registry)
    stat_only = [e for e in registry if not e.needs_content]
    nonsig = [e for e in without_signature(registry) if e.needs_content]
    listing = (list_files(spark, root) if listing is None else listing).where(F.col("length") > max_bytes)
    if only is not None:
        path = remap_root(F.col("path"), root_path(root), "")
        listing = listing.withColumn("path", path).join(only, "path", "left_semi")

    # A few rows: there is one per long file, and those are at most the bytes
    # of the folder divided by `max_bytes`. Signatures are read at their places.
    ranges = signature_ranges(registry)
    parts = read_parts(listing, ranges) if ranges else listing.withColumn("content", F.array().cast("array<binary>"))
    sig = parsers_by_parts(registry, F.col("content"))
    due = spool(parts.select("uri", "path", "name", "length", "mtime", sig.alias("sig")), "long-files")
    readers = F.when(F.size("sig") > 0, F.col("sig")).otherwise(_names(nonsig))
    by_line = [e for e in nonsig if e.records and e.python is None and e.long is None]
    streamed = [e for e in registry if e.python is not None and e.needs_content and e.streams]
    formed = [e for e in registry if e.python is None and e.long is not None]
    # A file without a signature goes by line to those that cut lines.
    unread = F.array_except(readers, _names(streamed + formed))
    unread = F.when(F.size("sig") > 0, unread).otherwise(F.array_except(unread, _names(by_line)))
    results = due.select("path", F.explode(unread).alias("parser")).select(
        F.lit(EXTRACTION_WARNING).alias("container"), "path", "parser", F.lit(0).cast("bigint").alias("seq"),
        F.lit(f"content exceeds {max_bytes} bytes and was not read whole").alias("message"),
        F.expr(f"CAST(map() AS {ATTRIBUTES})").alias("attributes"), F.expr(f"CAST(array() AS {TIMES})").alias("times"),
    )
    without = due.withColumn("content", F.lit(None).cast("binary"))
    if stat_only:
        items = without.select("path", "name", "length", "mtime", "content", F.explode(_names(stat_only)).alias("parser"))
        results = results.unionByName(run_extractors(items, stat_only))
    if streamed:
        items = without.select(
            "path", "name", "length", "mtime", "content", "uri", F.explode(F.array_intersect(readers, _names(streamed))).alias("parser")
        )
        results = results.unionByName(run_extractors(items, streamed))
    for extractor in formed:
        mine = due.where(F.array_contains(readers, extractor.name))
        if mine.isEmpty():
            continue
        found = long_items(mine.select("uri", "path", "name", "length", "mtime"), extractor.long, split_bytes)
        items = found.withColumns({"content": F.lit(None).cast("binary"), "parser": F.lit(extractor.name)})
        of_facts = replace(extractor, records=None, emits=extractor.long.emits)
        results = results.unionByName(run_extractors(items, [of_facts], seq="part"))
    if by_line:
        plain = due.where(F.size("sig") == 0)
        items = read_lines(plain, split_bytes).select(
            "path", "name", "length", "mtime", F.col("line").alias("content"), F.col("seq").alias("line_no"),
            F.explode(_names(by_line)).alias("parser"),
        )
        results = results.unionByName(run_extractors(items, by_line, seq="line_no"))
    return results


def _names(extractors: Iterable[Extractor]) -> Column:
    return F.array(*[F.lit(e.name) for e in extractors]).cast("array<string>")
