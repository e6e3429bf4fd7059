"""Path and name functions as Column expressions."""

from pyspark.sql import Column, functions as F

SEPARATOR = "/"


def basename(path: Column) -> Column:
    """Text after the last separator; a path ending in one is named by the separator."""
    last = F.substring_index(path, SEPARATOR, -1)
    return F.when(last == "", F.lit(SEPARATOR)).otherwise(last)


def _head(path: Column) -> Column:
    """Everything up to and including the last separator."""
    tail = F.substring_index(path, SEPARATOR, -1)
    return F.substr(path, F.lit(1), F.char_length(path) - F.char_length(tail))


def dirname(path: Column) -> Column:
    """Text before the last separator, its trailing separators dropped unless it is the root."""
    trimmed = F.rtrim(_head(path), F.lit(SEPARATOR))
    return F.when(trimmed == "", _head(path)).otherwise(trimmed)


def parent_dir(path: Column) -> Column:
    """Parent folder of an absolute path, `/` for a top-level entry, null for the root itself."""
    trimmed = F.rtrim(_head(path), F.lit(SEPARATOR))
    return F.when(path == SEPARATOR, F.lit(None)).when(trimmed == "", F.lit(SEPARATOR)).otherwise(trimmed)


def join_path(*segments: Column) -> Column:
    """One absolute path from segments; empty parts and doubled separators vanish."""
    joined = F.concat_ws(SEPARATOR, *segments)
    squeezed = F.regexp_replace(joined, r"/{2,}", SEPARATOR)
    return F.concat(F.lit(SEPARATOR), F.btrim(squeezed, F.lit(SEPARATOR)))


def with_store(path: Column, store: str) -> Column:
    """Path prefixed by the URI of the storage that holds it."""
    return F.concat(F.lit(store), path)


def remap_root(path: Column, old_root: str, new_root: str) -> Column:
    """Move a path from under one root to another; paths elsewhere stay as they are."""
    old, new = old_root.rstrip(SEPARATOR), new_root.rstrip(SEPARATOR)
    inside = path.startswith(old + SEPARATOR)
    return F.when(inside, F.concat(F.lit(new), F.substr(path, F.lit(len(old) + 1)))).otherwise(path)


def unpack_folder(path: Column, name: Column) -> Column:
    """Folder name for the content of a packed file.

    The suffix is a hash of the packed file's own path, so a rerun names the
    same folder and two archives of one name stay apart.
    """
    tag = F.substring(F.md5(path.cast("binary")), 1, 8)
    return F.concat(F.replace(name, F.lit("."), F.lit("_")), F.lit("_extracted"), tag)


def stream_member(name: Column) -> Column:
    """Name of the one file inside a compressed stream: up to the first dot."""
    stem = F.substring_index(name, ".", 1)
    return F.when(stem == "", F.lit("data")).otherwise(stem)


def path_prefixes(path: Column) -> Column:
    """All ancestor folders of an absolute path, root first, the path itself left out."""
    parts = F.filter(F.split(path, SEPARATOR), lambda part: part != "")
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda n: F.concat(F.lit(SEPARATOR), F.array_join(F.slice(parts, 1, n), SEPARATOR)),
    )
