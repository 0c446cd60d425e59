"""Reads that arrive over time: tags of each read on the stream, labels of clusters kept up to date batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.barcode import barcode_to_tags, route
from ..operators.clusters import partial_counts, summarize_counts


def ingest(reads: DataFrame, path: str, checkpoint: str, n_tags: int, rounds: dict[str, list[int]] | None = None) -> StreamingQuery:
    """A stream of named reads (qname ...), routed and tagged, appended to Parquet by route; all that is there is taken, then it ends."""
    tagged = barcode_to_tags(route(reads, rounds).where("route IN ('dpm', 'bpm')"), n_tags, clean=False)
    return tagged.writeStream.format("parquet").partitionBy("route").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class ClusterLabels:
    """Labels of clusters whose reads (cluster, read_type) arrive in batches, in a folder that all executors share.

    Each batch leaves its partial counts, and the summaries of the clusters that it touched, made of all counts of these up to it. Both
    lie in a folder named by the batch, which a batch that is run again overwrites, so a replay changes nothing. A cluster's
    present summary is that of its last batch.
    """

    def __init__(self, spark: SparkSession, folder: str, min_oligos: int = 2, proportion: float = 0.8, max_size: int = 10_000) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.ladder = (min_oligos, proportion, max_size)

    def _counts(self) -> DataFrame:
        return self.spark.read.schema("cluster string, target string, dpm long, n long, batch long").parquet(f"{self.folder}/counts")

    def merge(self, reads: DataFrame, batch: int) -> None:
        """Takes in a batch of reads; for foreachBatch. Only clusters that the batch touches are summed and labelled again."""
        own = f"{self.folder}/counts/batch={batch}"
        partial_counts(reads.select(F.col("cluster").cast("string").alias("cluster"), "read_type")).write.mode("overwrite").parquet(own)
        touched = self.spark.read.schema("cluster string").parquet(own).distinct()
        upto = self._counts().where(F.col("batch") <= batch).join(touched, "cluster", "left_semi")
        summed = upto.groupBy("cluster", "target").agg(F.sum("dpm").alias("dpm"), F.sum("n").alias("n"))
        summarize_counts(summed, *self.ladder).write.mode("overwrite").parquet(f"{self.folder}/labels/batch={batch}")

    def compact(self, upto: int) -> None:
        """Sums the counts of all batches up to one into that batch's folder beside, for a stream to go on from; call it while no batch runs."""
        summed = self._counts().where(F.col("batch") <= upto).groupBy("cluster", "target").agg(F.sum("dpm").alias("dpm"), F.sum("n").alias("n"))
        summed.write.mode("overwrite").parquet(f"{self.folder}/compacted")
        files = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        root = files.Path(f"{self.folder}/counts")
        system = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for status in system.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("batch=") and int(name[6:]) <= upto:
                system.delete(status.getPath(), True)
        system.rename(files.Path(f"{self.folder}/compacted"), files.Path(root, f"batch={upto}"))

    def labels(self) -> DataFrame:
        """The summaries of all clusters as they are now."""
        rows = self.spark.read.parquet(f"{self.folder}/labels")
        columns = [c for c in rows.columns if c not in ("cluster", "batch")]
        return rows.groupBy("cluster").agg(F.max_by(F.struct(*columns), "batch").alias("row")).select("cluster", "row.*")

    def run(self, reads: DataFrame, checkpoint: str) -> StreamingQuery:
        """Takes in all that a stream of reads has, batch by batch, then ends."""
        return reads.writeStream.foreachBatch(self.merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
