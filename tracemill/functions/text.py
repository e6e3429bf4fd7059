"""Character set detection and decoding."""

import codecs
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Byte order marks of the character sets.
UTF8_MARK = b"\xef\xbb\xbf"
UTF16_BIG_MARK = b"\xfe\xff"
UTF16_LITTLE_MARK = b"\xff\xfe"

WIDE_CHARSET = "UTF-16"


def charset(content: Column, fallback: str | None = None) -> Column:
    """Character set of `content`: byte order mark, else valid UTF-8, else `fallback`."""
    wide = F.startswith(content, F.lit(UTF16_BIG_MARK)) | F.startswith(content, F.lit(UTF16_LITTLE_MARK))
    return (
        F.when(wide, F.lit(WIDE_CHARSET))
        .when(F.is_valid_utf8(content.cast("string")), F.lit("UTF-8"))
        .otherwise(F.lit(fallback).cast("string"))
    )


# What the JVM decodes whatever the bytes are; every other set is decoded by Python's codecs.
_TOTAL = "ISO-8859-1"


def _decoder(charset_name: str):
    """Bytes in one character set as text; input that is not well formed gives null, not a failed job."""
    codecs.lookup(charset_name)

    def one(raw):
        if raw is None:
            return None
        try:
            return bytes(raw).decode(charset_name)
        except UnicodeDecodeError:
            return None

    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(one).astype(object)

    return F.pandas_udf(decode, "string")


def decode_text(files: DataFrame, fallback: str | None = None) -> DataFrame:
    """Add `charset`, `text` and `warning`; the bytes stay beside the text.

    UTF-8 and ISO-8859-1 text is decoded in the JVM. Only files in another set
    hand their bytes to Python, since the JVM decoder knows few sets and ends
    the job on bad input; every other row passes a null. An unknown name of a
    set is an error when the plan is made.
    """
    content = F.col("content")
    marked = F.startswith(content, F.lit(UTF8_MARK))
    body = F.when(marked, F.substr(content, F.lit(len(UTF8_MARK) + 1))).otherwise(content)
    found = files.withColumn("charset", charset(content, fallback))
    wide = _decoder(WIDE_CHARSET)(F.when(F.col("charset") == WIDE_CHARSET, content))
    text = F.when(F.col("charset") == WIDE_CHARSET, wide).when(F.col("charset") == "UTF-8", body.cast("string"))
    if fallback:
        mine = F.col("charset") == fallback
        if codecs.lookup(fallback) == codecs.lookup(_TOTAL):
            text = text.when(mine, F.decode(content, _TOTAL))
        else:
            text = text.when(mine, _decoder(fallback)(F.when(mine, content)))
    return found.withColumn("text", text).withColumn(
        "warning", F.when(F.col("text").isNull() & content.isNotNull(), F.lit("unable to decode text"))
    )
