"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this package relies on. Shuffle partition count is
# left to the caller: on a cluster it comes from the cluster profile and AQE
# coalesces small partitions at runtime.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Scratch folders written by this process, per application.
_SCRATCH: dict[str, list[str]] = {}


class SharedFolderError(RuntimeError):
    pass


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "voltcube", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


#: Bytes of an Arrow batch, about: rows may hold whole documents, of which the usual 10,000 would be tens of MB in the
#: JVM and in each Python worker.
ARROW_BATCH = 4 << 20


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL settings this package depends on: semantics, and the memory of Arrow batches."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH))


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors for written tables.

    Uses the checkpoint folder the cluster names in ``spark.checkpoint.dir``.
    Only a local master (one machine, tests) gets a temporary folder when it
    names none; on a cluster each executor would write to its own disk, so
    that is an error."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not is_local(sc.master):
                raise SharedFolderError(f"master {sc.master} needs spark.checkpoint.dir: a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="voltcube-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def is_local(master: str) -> bool:
    """Driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    path = f"{shared_dir(spark)}/voltcube/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(spark: SparkSession, df, name: str):
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage (later plans start from the files, and a lost executor
    re-reads them instead of recomputing the joins) in one job; used for
    bounded intermediates that several later steps read."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path in any store Spark reaches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables of this application; frames that read them are invalid afterwards."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        delete(spark, p)
    return len(paths)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
