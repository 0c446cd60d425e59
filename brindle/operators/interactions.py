"""Co-occurrence of targets in clusters, from counts (cluster, target, n)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def interaction_matrix(counts: DataFrame, min_oligos: int = 2, proportion: float = 0.1, weight: str = "none", labels: list[str] | None = None, cluster: str = "cluster") -> DataFrame:
    """(target_i, target_j, value), i <= j: clusters in which both have min_oligos reads and a share of the listed labels' reads.

    weight "none" counts clusters, "n_over_two" sums two over the passing targets. A cluster gives at most as many pairs as
    targets that pass, of which there are at most 1 / proportion.
    """
    if labels is not None:
        counts = counts.where(F.col("target").isin(labels))
    total = F.sum("n").over(Window.partitionBy(cluster))
    passing = counts.withColumn("total", total).where((F.col("n") >= min_oligos) & (F.col("n") >= proportion * F.col("total")))
    sets = passing.groupBy(cluster).agg(F.array_sort(F.collect_set("target")).alias("targets"))
    pairs = F.flatten(F.transform("targets", lambda a: F.transform(F.filter("targets", lambda b: b >= a), lambda b: F.struct(a.alias("target_i"), b.alias("target_j")))))
    value = {"none": F.lit(1.0), "n_over_two": 2.0 / F.size("targets")}[weight]
    return sets.select(value.alias("w"), F.inline(pairs)).groupBy("target_i", "target_j").agg(F.sum("w").alias("value"))


def full_matrix(upper: DataFrame) -> DataFrame:
    """Both halves of a matrix whose upper half is given."""
    return upper.unionByName(upper.where("target_i <> target_j").select(F.col("target_j").alias("target_i"), F.col("target_i").alias("target_j"), "value"))


def normalize_by_clusters(matrix: DataFrame) -> DataFrame:
    """Each row over its diagonal."""
    diagonal = matrix.where("target_i = target_j").select("target_i", F.col("value").alias("d"))
    return matrix.join(diagonal, "target_i", "left").select("target_i", "target_j", (F.col("value") / F.nullif("d", F.lit(0.0))).alias("value"))


def normalize_by_pairwise(matrix: DataFrame) -> DataFrame:
    """Off-diagonal values over their row's sum; the diagonal is 0."""
    off = F.when(F.col("target_i") == F.col("target_j"), 0.0).otherwise(F.col("value"))
    return matrix.withColumn("value", off).withColumn("value", F.coalesce(F.col("value") / F.nullif(F.sum("value").over(Window.partitionBy("target_i")), F.lit(0.0)), F.lit(0.0)))


def log_matrix(matrix: DataFrame, pseudocount: float | str = "min_over_ten") -> DataFrame:
    """log10 of values plus a pseudocount; min_over_ten is a tenth of the smallest positive value."""
    if pseudocount == "min_over_ten":
        least = matrix.agg((F.min(F.when(F.col("value") > 0, F.col("value"))) / 10).alias("p"))
        matrix = matrix.crossJoin(F.broadcast(least))
    else:
        matrix = matrix.withColumn("p", F.lit(float(pseudocount)))
    return matrix.select("target_i", "target_j", F.log10(F.col("value") + F.col("p")).alias("value"))


def to_dense(counts: DataFrame, labels: list[str], cluster: str = "cluster") -> DataFrame:
    """One column for each label, 0 where a cluster has none; other labels are dropped."""
    return counts.where(F.col("target").isin(labels)).groupBy(cluster).pivot("target", labels).agg(F.sum("n")).na.fill(0, labels)
