"""Clusters of reads: label by majority of oligos, histograms, summaries. Reads have cluster, read_type (DPM... or BEAD_<target>)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNASSIGNED = ("none", "filtered", "uncertain", "ambiguous")
OLIGO = "BEAD_"


def target_of(read_type: Column, prefix: str = OLIGO) -> Column:
    """The target that an oligo read names; null for other reads."""
    return F.when(read_type.startswith(prefix), read_type.substr(F.lit(len(prefix) + 1), F.length(read_type)))


def label_of(n_dpm: Column, n_oligo: Column, mode_count: Column, mode: Column, min_oligos: int, proportion: float, max_size: int) -> Column:
    """The ladder: none, filtered, uncertain, ambiguous, else the most frequent target."""
    return (
        F.when(n_oligo == 0, "none")
        .when(n_dpm > max_size, "filtered")
        .when(mode_count < min_oligos, "uncertain")
        .when(mode_count / n_oligo < proportion, "ambiguous")
        .otherwise(mode)
    )


def target_counts(reads: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, target, n) of oligo reads."""
    return reads.select(cluster, target_of(F.col("read_type")).alias("target")).where("target IS NOT NULL").groupBy(cluster, "target").agg(F.count("*").alias("n"))


def partial_counts(reads: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, target, dpm, n): a cluster's reads by target, DPM reads among those without one. Counts of parts of the reads add up."""
    kind = F.when(F.col("read_type").startswith("DPM"), F.lit(None)).otherwise(target_of(F.col("read_type")))
    return reads.select(cluster, kind.alias("target"), F.col("read_type").startswith("DPM").cast("long").alias("dpm")).groupBy(cluster, "target").agg(F.sum("dpm").alias("dpm"), F.count("*").alias("n"))


def summarize_counts(counts: DataFrame, min_oligos: int = 2, proportion: float = 0.8, max_size: int = 10_000, cluster: str = "cluster") -> DataFrame:
    """One row for each cluster of partial counts, as summarize_clusters gives it."""
    oligo = F.when(F.col("target").isNotNull(), F.col("n"))
    best = F.max(F.when(F.col("target").isNotNull(), F.col("n"))).alias("mode_count")
    grouped = counts.groupBy(cluster).agg(
        F.coalesce(F.sum("dpm"), F.lit(0)).alias("n_dpm"),
        F.coalesce(F.sum(oligo), F.lit(0)).alias("n_oligo"),
        best,
        F.min(F.when(F.col("target").isNotNull(), F.struct((-F.col("n")).alias("k"), F.col("target")))).getField("target").alias("mode"),
    )
    grouped = grouped.withColumn("mode_count", F.coalesce("mode_count", F.lit(0)))
    label = label_of(F.col("n_dpm"), F.col("n_oligo"), F.col("mode_count"), F.col("mode"), min_oligos, proportion, max_size)
    share = F.when(F.col("n_oligo") > 0, F.col("mode_count") / F.col("n_oligo")).otherwise(0.0)
    return grouped.withColumn("share", share).withColumn("label", label)


def summarize_clusters(reads: DataFrame, min_oligos: int = 2, proportion: float = 0.8, max_size: int = 10_000, cluster: str = "cluster") -> DataFrame:
    """One row for each cluster: n_dpm, n_oligo, mode (smallest name on ties), mode_count, share, label.

    Two partial aggregations, so a cluster of any size stays counts; read types other than DPM and oligos count in neither.
    """
    return summarize_counts(partial_counts(reads, cluster), min_oligos, proportion, max_size, cluster)


def reads_per_cluster(clusters: DataFrame) -> DataFrame:
    """(label, read_type, reads_per_cluster, n_clusters) for total, DPM and BPM reads."""
    kinds = F.array(
        F.struct(F.lit("total").alias("read_type"), (F.col("n_dpm") + F.col("n_oligo")).alias("reads_per_cluster")),
        F.struct(F.lit("DPM").alias("read_type"), F.col("n_dpm").alias("reads_per_cluster")),
        F.struct(F.lit("BPM").alias("read_type"), F.col("n_oligo").alias("reads_per_cluster")),
    )
    return clusters.select("label", F.inline(kinds)).groupBy("label", "read_type", "reads_per_cluster").agg(F.count("*").alias("n_clusters"))


def in_order(statistics: DataFrame) -> DataFrame:
    """Rows of reads_per_cluster() or max_representation() by label, kind and value."""
    return statistics.orderBy("label", *(c for c in ("read_type", "metric") if c in statistics.columns), *(c for c in ("reads_per_cluster", "value") if c in statistics.columns))


def max_representation(clusters: DataFrame) -> DataFrame:
    """(label, metric, value, n_clusters): counts of the most frequent target, and its share, rounded to hundredths as Python rounds it, in hundredths."""

    @F.pandas_udf("long")
    def hundredths(most: pd.Series, total: pd.Series) -> pd.Series:
        return pd.Series([round(100 * round(a / b, 2)) if b else 0 for a, b in zip(most, total)], dtype="int64")

    # Only distinct pairs of counts pass Python.
    pairs = clusters.groupBy("label", "mode_count", "n_oligo").agg(F.count("*").alias("n")).withColumn("share", hundredths("mode_count", "n_oligo"))
    kinds = F.array(F.struct(F.lit("count").alias("metric"), F.col("mode_count").alias("value")), F.struct(F.lit("proportion").alias("metric"), F.col("share").alias("value")))
    return pairs.select("label", "n", F.inline(kinds)).groupBy("label", "metric", "value").agg(F.sum("n").alias("n_clusters"))


def label_reads(reads: DataFrame, clusters: DataFrame, cluster: str = "cluster") -> DataFrame:
    """reads with RG (the label, on DPM reads), YG (the label, on oligo reads) and YC (DPM reads of the cluster, on oligo reads). Reads of any other type, or of none, are skipped."""
    dpm, oligo = F.col("read_type").startswith("DPM"), F.col("read_type").startswith(OLIGO)
    joined = reads.where(dpm | oligo).join(clusters.select(cluster, "label", "n_dpm"), cluster)
    return joined.withColumn("RG", F.when(dpm, F.col("label"))).withColumn("YG", F.when(~dpm, F.col("label"))).withColumn("YC", F.when(~dpm, F.col("n_dpm"))).drop("label", "n_dpm")


def counts_by_type(records: DataFrame, patterns: dict[str, str], tag: str = "RT") -> DataFrame:
    """(kind, n): records whose tag (a column, or an entry of `tags`) begins as a pattern says, such as {"dpm": "^DPM", "bpm": "^BEAD"}; a record counts for each that fits."""
    value = F.try_element_at("tags", F.lit(tag)) if "tags" in records.columns else F.col(tag)
    kinds = F.array(*[F.when(F.coalesce(value.rlike(p), F.lit(False)), F.lit(kind)) for kind, p in patterns.items()])
    found = records.select(F.explode(kinds).alias("kind")).where("kind IS NOT NULL").groupBy("kind").agg(F.count("*").alias("n"))
    every = records.sparkSession.createDataFrame([(kind,) for kind in patterns], "kind string")
    return every.join(found, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))


def counts_per_label(clusters: DataFrame) -> DataFrame:
    """(label, n_clusters, n_dpm, n_oligo, dpm_per_cluster, oligo_per_cluster)."""
    return clusters.groupBy("label").agg(F.count("*").alias("n_clusters"), F.sum("n_dpm").alias("n_dpm"), F.sum("n_oligo").alias("n_oligo"), F.round(F.avg("n_dpm"), 6).alias("dpm_per_cluster"), F.round(F.avg("n_oligo"), 6).alias("oligo_per_cluster"))


def cluster_totals(clusters: DataFrame) -> DataFrame:
    """Clusters in all, without oligos, without chromatin, and with both."""
    return clusters.agg(
        F.count("*").alias("n_clusters"),
        F.count_if(F.col("n_oligo") == 0).alias("without_oligos"),
        F.count_if(F.col("n_dpm") == 0).alias("without_chromatin"),
        F.count_if((F.col("n_dpm") > 0) & (F.col("n_oligo") > 0)).alias("with_both"),
    )


def mixed_share(clusters: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Shares of clusters with oligos, and of their chromatin, whose top target has less than all, and less than threshold."""
    own = clusters.where("n_oligo > 0")
    mixed, below = F.col("mode_count") < F.col("n_oligo"), F.col("mode_count") / F.col("n_oligo") < threshold
    part = lambda c, w: F.round(F.sum(F.when(c, w).otherwise(0)) / F.sum(w), 6)
    return own.agg(part(mixed, F.lit(1)).alias("mixed_clusters"), part(below, F.lit(1)).alias("below_clusters"), part(mixed, F.col("n_dpm")).alias("mixed_chromatin"), part(below, F.col("n_dpm")).alias("below_chromatin"))


def uncertain_targets(reads: DataFrame, clusters: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(target, unique_clusters, mixed_clusters, unique_dpm, mixed_dpm) of clusters labelled uncertain."""
    counts = target_counts(reads, cluster).join(clusters.where("label = 'uncertain'").select(cluster, "n_dpm", "n_oligo"), cluster)
    unique = F.col("n") == F.col("n_oligo")
    return counts.groupBy("target").agg(F.count_if(unique).alias("unique_clusters"), F.count_if(~unique).alias("mixed_clusters"), F.sum(F.when(unique, F.col("n_dpm")).otherwise(0)).alias("unique_dpm"), F.sum(F.when(unique, 0).otherwise(F.col("n_dpm"))).alias("mixed_dpm"))


def count_signatures(reads: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(signature, n_clusters, share): sorted counts of a cluster's targets, joined by commas. A signature is as long as the targets are many."""
    own = target_counts(reads, cluster).groupBy(cluster).agg(F.array_join(F.array_sort(F.collect_list("n")), ",").alias("signature"))
    grouped = own.groupBy("signature").agg(F.count("*").alias("n_clusters"))
    return grouped.crossJoin(F.broadcast(own.agg(F.count("*").alias("all")))).select("signature", "n_clusters", F.round(F.col("n_clusters") / F.col("all"), 6).alias("share"))


def signature_chromatin(reads: DataFrame, clusters: DataFrame, signature: str, cluster: str = "cluster") -> DataFrame:
    """(n_dpm, n_clusters) of clusters whose targets' sorted counts are exactly a signature such as `1,3`."""
    counts = [int(n) for n in signature.split(",")]
    # Clusters with as many targets and the same sum come first, so that no long list is made of others.
    own = target_counts(reads, cluster).groupBy(cluster).agg(F.count("*").alias("k"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.when(F.col("n") <= max(counts), F.col("n")))).alias("counts"))
    own = own.where((F.col("k") == len(counts)) & (F.col("total") == sum(counts)) & (F.array_join("counts", ",") == signature))
    return clusters.join(own.select(cluster), cluster).agg(F.sum("n_dpm").alias("n_dpm"), F.count("*").alias("n_clusters"))


def interacting(clusters: DataFrame, min_count: int = 2, least: float = 0.1, max_dpm: int = 200, max_oligo: int = 30) -> DataFrame:
    """Clusters with chromatin, a repeated top target of a share, and sizes within bounds."""
    return clusters.where((F.col("n_dpm") > 0) & (F.col("n_dpm") <= max_dpm) & (F.col("mode_count") >= min_count) & (F.col("mode_count") >= least * F.col("n_oligo")) & (F.col("n_oligo") <= max_oligo))


def multi_target(counts: DataFrame, cluster: str = "cluster", least: int = 2, share: float = 0.1) -> DataFrame:
    """Clusters (of counts: cluster, target, n) with two targets of a count and two of a share."""
    total = F.sum("n").over(Window.partitionBy(cluster))
    return counts.withColumn("total", total).groupBy(cluster).agg(F.count_if(F.col("n") >= least).alias("repeated"), F.count_if(F.col("n") >= share * F.col("total")).alias("large")).where("repeated >= 2 AND large >= 2")


def representation_change(before: DataFrame, after: DataFrame, key: str = "target", value: str = "n") -> DataFrame:
    """(key, change): the difference of a key's shares in two count tables that both have it."""
    joined = before.select(key, F.col(value).alias("b")).join(after.select(key, F.col(value).alias("a")), key)
    sums = joined.agg(F.sum("b").alias("tb"), F.sum("a").alias("ta"))
    return joined.crossJoin(F.broadcast(sums)).select(key, F.round(F.col("b") / F.col("tb") - F.col("a") / F.col("ta"), 6).alias("change"))


def resolved_share(clusters: DataFrame, *by: str) -> DataFrame:
    """The share of chromatin reads in clusters with a target for label."""
    return clusters.groupBy(*by).agg(F.round(F.sum(F.when(~F.col("label").isin(*UNASSIGNED), F.col("n_dpm")).otherwise(0)) / F.nullif(F.sum("n_dpm"), F.lit(0)), 6).alias("resolved"))


def read_groups(targets: DataFrame, sample: str) -> DataFrame:
    """(id, sm): the read groups of a header: one for each target (of targets: target), and one for each label of clusters without a target."""
    spark = targets.sparkSession
    others = spark.createDataFrame([(label,) for label in UNASSIGNED], "id string")
    return targets.select(F.col("target").alias("id")).where("id IS NOT NULL").unionByName(others).distinct().withColumn("sm", F.lit(sample))


def concatenated(samples: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """The clusters of samples, name -> (records, chromosome sizes), as one table with the sample; all must have the same chromosomes and lengths."""
    (first, (out, sizes)), *rest = samples.items()
    out = out.withColumn("sample", F.lit(first))
    for name, (records, other) in rest:
        if sizes.exceptAll(other).limit(1).count() or other.exceptAll(sizes).limit(1).count():
            raise ValueError(f"samples {first} and {name} have other chromosomes")
        out = out.unionByName(records.withColumn("sample", F.lit(name)))
    return out


def write_summaries(clusters: DataFrame, path: str) -> None:
    """Cluster summaries as CSV, and the distribution of labels as gzip JSON lines."""
    clusters.write.csv(f"{path}/clusters", header=True)
    clusters.groupBy("label").agg(F.count("*").alias("n_clusters")).coalesce(1).write.json(f"{path}/labels", compression="gzip")
