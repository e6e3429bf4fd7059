"""Extractor chains: the names of nested extractors joined outermost first."""

from pyspark.sql import Column, functions as F

LINK = "/"


def chain(*names: Column) -> Column:
    return F.concat_ws(LINK, *names)


def append(parent: Column, name: Column) -> Column:
    return F.when(parent == "", name).otherwise(F.concat_ws(LINK, parent, name))


def pop(parser: Column) -> Column:
    """The chain without its innermost name; a single name leaves the empty chain."""
    names = F.split(parser, LINK)
    return F.array_join(F.slice(names, F.lit(1), F.size(names) - 1), LINK)


def root(parser: Column) -> Column:
    return F.substring_index(parser, LINK, 1)


def depth(parser: Column) -> Column:
    return F.size(F.split(parser, LINK))
