"""Named formatters: a result row as one text document."""

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

Formatter = Callable[[DataFrame], Column]

_FORMATTERS: dict[str, Formatter] = {}


def register_formatter(name: str, formatter: Formatter) -> None:
    """Make a formatter known; the last one registered under a name counts."""
    _FORMATTERS[name] = formatter


def get_formatter(name: str | None) -> Formatter | None:
    """The formatter of that name; none asked for is none, an unknown name an error."""
    if not name:
        return None
    if name not in _FORMATTERS:
        raise ValueError(f"unknown formatter {name!r}; known: {', '.join(sorted(_FORMATTERS))}")
    return _FORMATTERS[name]


def _sorted_keys(column: Column, kind: T.DataType) -> Column:
    """A value with the keys of all its structs and maps in sorted order."""
    if isinstance(kind, T.StructType):
        fields = [_sorted_keys(column[f.name], f.dataType).alias(f.name) for f in sorted(kind, key=lambda f: f.name)]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.MapType):
        return F.when(F.size(column) > 1, F.map_from_entries(F.array_sort(F.map_entries(column)))).otherwise(column)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        fields = sorted(kind.elementType, key=lambda f: f.name)
        if any(isinstance(f.dataType, (T.StructType, T.MapType, T.ArrayType)) for f in fields):
            return F.transform(column, lambda e: _sorted_keys(e, kind.elementType))
        # Without a lambda the reordering stays in generated code.
        return F.arrays_zip(*[column[f.name] for f in fields])
    return column


def json_document(df: DataFrame, pretty: bool = True) -> Column:
    """Each row as a JSON object: keys sorted, nulls kept, non-ASCII text escaped."""
    fields = [_sorted_keys(F.col(f.name), f.dataType).alias(f.name) for f in sorted(df.schema, key=lambda f: f.name)]
    return F.to_json(
        F.struct(*fields),
        {
            "ignoreNullFields": "false",
            "writeNonAsciiCharacterAsCodePoint": "true",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
            "pretty": str(pretty).lower(),
        },
    )


def _indent(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(lambda text: json.dumps(json.loads(text), indent=4, sort_keys=True))


def json_indent4(df: DataFrame) -> Column:
    """The same document laid out with four spaces, byte for byte as Python's json module does."""
    return F.pandas_udf(_indent, "string")(json_document(df, pretty=False))


register_formatter("json", json_document)
register_formatter("json-indent4", json_indent4)


def format_results(results: DataFrame, name: str) -> DataFrame:
    """One document per result row, beside its container."""
    return results.select("container", get_formatter(name)(results).alias("document"))
