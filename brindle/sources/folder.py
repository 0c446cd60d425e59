"""Names of new tables and files in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where that is unset, and the session local, a temporary folder, which executors of a cluster would not share."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = getattr(shared, "own", None) or tempfile.mkdtemp(prefix="spark-tables-")
        shared.own = base
    return base.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path that does not exist yet."""
    return f"{shared(spark)}/files/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet and read again: what follows does not compute it again. `path_of` tells where it lies."""
    path = fresh(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.path_of = path
    return out


def removed(*tables: DataFrame) -> None:
    """Deletes what written() wrote, once nothing reads it any more."""
    for table in tables:
        session = table.sparkSession
        path = session.sparkContext._jvm.org.apache.hadoop.fs.Path(table.path_of)
        path.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def local(path: str) -> str:
    """A path for Python's open(): of a file system that every executor mounts."""
    for prefix in ("file://", "file:"):
        if path.startswith(prefix):
            return path[len(prefix) :]
    return path
