"""Session settings and the shared folder used for intermediate tables."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are designed for. Batches are bounded in bytes because a
# row may carry a whole file.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}

_LOCAL_SHARED: dict[str, str] = {}
# Folders handed out by `shared_dir`, by application.
_MADE: dict[str, list[str]] = {}


def build_session(app_name: str = "tracemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; `conf` keys use `_` for `.`-free names only."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under `spark.checkpoint.dir`, reachable by every executor.

    Only a local master, whose tasks share the driver's disk, may go without
    the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_SHARED:
            _LOCAL_SHARED[app] = tempfile.mkdtemp(prefix="tracemill-")
            atexit.register(shutil.rmtree, _LOCAL_SHARED[app], ignore_errors=True)
        base = _LOCAL_SHARED[app]
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables this session made and return their number.

    For the end of a run: DataFrames that still read them can't be used any more.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    for folder in made:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return len(made)


def spool(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), compression: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and go on from the written table.

    This cuts lineage and survives lost executors; unlike a checkpoint the
    table keeps column pruning, partition pruning and splittable row groups, so
    one task's large output is read back by many.
    """
    spark = df.sparkSession
    out = shared_dir(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(out)
    return spark.read.schema(df.schema).parquet(out)
