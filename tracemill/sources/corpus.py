"""The analytic test tables seen as a tree of files."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracemill.sources.files import as_files


# The columns used; stating them spares a job per table to find them out.
COLUMNS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING",
    "pages": "page_id BIGINT, html STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, text STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _file(df: DataFrame, path: list[Column | str], body: str, mtime: str | None = None) -> DataFrame:
    parts = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in path]
    stamp = F.col(mtime) if mtime else F.lit(None)
    return df.select(
        F.concat(*parts).alias("path"),
        F.col(body).cast("binary").alias("content"),
        stamp.cast("timestamp_ntz").alias("mtime"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, pages, conversation turns and event properties, one file per row."""
    c = F.col
    sources = [
        _file(
            table(spark, sf_dir, "documents"),
            ["/documents/", c("lang"), "/", c("source"), "/", c("doc_id"), ".txt"],
            "text",
        ),
        _file(table(spark, sf_dir, "pages"), ["/pages/", c("page_id"), ".html"], "html"),
        _file(
            table(spark, sf_dir, "conversations"),
            ["/conversations/", c("conv_id"), "/", c("turn"), ".txt"],
            "text",
        ),
        _file(
            table(spark, sf_dir, "events"),
            ["/events/", c("event_type"), "/", c("event_id"), ".json"],
            "props",
            "ts",
        ),
    ]
    return as_files(reduce(DataFrame.unionByName, sources))


def user_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows located in one log file per user."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "ts",
        F.concat(F.lit("/logs/user_"), F.col("user_id").cast("string"), F.lit(".log")).alias("path"),
    )
