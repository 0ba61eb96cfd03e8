"""Sessions, tables, and intermediate results that outlive the executors that made them."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "tessella", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC time and adaptive execution; on a cluster, the master comes from spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: below ``spark.checkpoint.dir``, which all executors share.

    Where that setting is absent (tests, a local session) a temporary folder is used; on a cluster this is an error,
    as executors do not share the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a compressed Parquet table in the scratch folder and read it back.

    Cuts lineage like ``checkpoint()``, but keeps columns prunable and their sizes known to the optimizer. The files
    are removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tessella-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Removes the files of a materialized table that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _remove(df.sparkSession, path)


def broadcast_if_small(df: DataFrame, most_bytes: int = 32 << 20) -> DataFrame:
    """``df`` marked for broadcast if its rows measure at most ``most_bytes``, else as it is.

    Rows are measured as JSON, which no type exceeds by much in memory; meant for tables that are written already.
    """
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})))).first()[0] or 0
    return F.broadcast(df) if size <= most_bytes else df


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone already
        pass
