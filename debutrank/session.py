"""Session settings and the shared folder for tables written between jobs."""

from __future__ import annotations

import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
_folders: dict[str, str] = {}  # by application, as handed in by the caller
_bucketed: dict[str, list[str]] = {}  # by application, tables to drop from the catalog


def local_session(cpus: int | str = 8, app: str = "debutrank", memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def use_folder(spark: SparkSession, path: str) -> None:
    """Name the work folder of a session that was started without ``spark.checkpoint.dir``.

    On a cluster it has to be one that the driver and all executors share.
    """
    _folders[spark.sparkContext.applicationId] = path.rstrip("/")


def named_folder(spark: SparkSession) -> str | None:
    """The folder of ``spark.checkpoint.dir``, else the one handed in, else none."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    return named.rstrip("/") if named else _folders.get(spark.sparkContext.applicationId)


def shared_dir(spark: SparkSession) -> str:
    folder = named_folder(spark)
    if not folder:
        raise RuntimeError(f"set {CHECKPOINT_DIR}, or call use_folder, with a folder that all executors share")
    return folder


def session_dir(spark: SparkSession) -> str:
    """Where this session writes, below the shared folder."""
    return f"{shared_dir(spark)}/debutrank/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{session_dir(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Drop all that this session has written; frames that still read it fail from then on."""
    for name in _bucketed.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(
    df: DataFrame, label: str, partition_by: str | None = None, compression: str = "snappy"
) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that several consumers share one computation, survives the
    loss of executors, and gives the readers column pruning and true size statistics
    (which is what lets Spark decide on its own whether a side may be broadcast).
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    writer = df.write.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_with_extrema(df: DataFrame, label: str, columns: Sequence[str]) -> tuple[DataFrame, dict]:
    """``written``, and ``<column>_max`` and ``<column>_min`` as they were observed in passing.

    A task that runs twice is observed twice, which does not change a maximum or minimum.
    """
    seen = Observation()
    measures = [f(c).alias(f"{c}_{f.__name__}") for c in columns for f in (F.max, F.min)]
    return written(df.observe(seen, *measures), label), seen.get


def bucketed(
    df: DataFrame, label: str, by: Sequence[str], buckets: int | None = None, compression: str = "snappy"
) -> DataFrame:
    """Write ``df`` in buckets of the hash of ``by`` and read it back.

    Joins, aggregations and windows on ``by`` of tables with as many buckets need no exchange. The
    number is that of the shuffle partitions unless it is given. Every bucket is one file, written by one task.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"debutrank_{label}_{uuid.uuid4().hex}".replace("-", "_")
    writer = df.repartition(buckets, *by).write.bucketBy(buckets, *by)
    writer.option("path", shared_path(spark, label)).option("compression", compression).format("parquet").saveAsTable(name)
    _bucketed.setdefault(spark.sparkContext.applicationId, []).append(name)
    return spark.table(name)
