"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.folder import shared


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where it is unset, as in local tests, a temporary folder, which executors of a cluster would not share."""
    return shared(spark)


#: The tables written within each open or past scope(), by its name.
_written: dict[str, list[str]] = {}
_scopes: list[str] = []


@contextmanager
def scope(name: str) -> Iterator[None]:
    """Tables that are materialized within belong to `name`, so that swept() can delete them."""
    _scopes.append(name)
    try:
        yield
    finally:
        _scopes.pop()


def _roots(df: DataFrame) -> str:
    """The folders that a plan reads, one behind another."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = [leaves.apply(k) for k in range(leaves.size())]
    return " ".join(leaf.relation().location().rootPaths().mkString(" ") for leaf in found if leaf.getClass().getSimpleName() == "LogicalRelation")


def swept(spark: SparkSession, name: str, unless: DataFrame) -> None:
    """Deletes the tables of a scope, but not while `unless` still reads one of them, and lets Spark drop the shuffles of plans that are gone."""
    session, read = spark.sparkContext, _roots(unless)
    if not any(path.rsplit("/", 1)[1] in read for path in _written.get(name, [])):
        for path in _written.pop(name, []):
            at = session._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(session._jsc.hadoopConfiguration()).delete(at, True)
    gc.collect()
    session._jvm.System.gc()


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """df written once as Parquet in the shared folder and read again: a lost executor costs no recomputation beyond it. With keep it belongs to no scope."""
    path = f"{shared_folder(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    if _scopes and not keep:
        _written.setdefault(_scopes[-1], []).append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a few short columns that may be broadcast: some tens of MB.
MOST_BROADCAST = 1 << 20


def bounded(rows: DataFrame, most: int = MOST_BROADCAST) -> DataFrame:
    """A written table, to be broadcast if it has `most` rows at most, which are counted; else as it is, for a join that shuffles and whose hot keys Spark splits."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of an Arrow batch: texts can be long, and a task's Python holds a whole batch on both sides.
BATCH_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; from now on the session sends Python BATCH_ROWS rows at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
