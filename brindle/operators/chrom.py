"""Chromosome names: renaming, filtering and ordering of records, headers and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNMAPPED, SECONDARY = 4, 256


def mapped_primary(records: DataFrame, least: int = 20) -> DataFrame:
    """Mapped primary records (flag, mapq) of a mapping quality."""
    return records.where((F.col("mapq") >= least) & (F.col("flag").bitwiseAND(UNMAPPED | SECONDARY) == 0))


def rename_chromosomes(records: DataFrame, names: DataFrame, column: str = "rname", mate: str | None = None) -> DataFrame:
    """records of the chromosomes in names (old, new, sort_order), renamed; a mate elsewhere is `*`."""
    out = records.join(F.broadcast(names.select(F.col("old").alias(column), "new", "sort_order")), column).withColumn(column, F.col("new")).drop("new")
    if mate is not None:
        out = out.join(F.broadcast(names.select(F.col("old").alias(mate), F.col("new").alias("_mate"))), mate, "left").withColumn(mate, F.coalesce("_mate", F.lit("*"))).drop("_mate")
    return out.select(*records.columns, "sort_order")


def reheader(sizes: list[tuple[str, int]], order: str, names: list[tuple[str, str]]) -> tuple[list[tuple[str, int]], str, dict[int, int], bool]:
    """Sequences (name, length) renamed and ordered by names (old, new): (sequences, sort order, old to new index, whether order is kept)."""
    place = {name: k for k, (name, _) in enumerate(sizes)}
    missing = [old for old, _ in names if old not in place]
    if missing:
        raise KeyError(missing[0])
    old_ids = [place[old] for old, _ in names]
    kept = all(a < b for a, b in zip(old_ids, old_ids[1:]))
    return [(new, sizes[place[old]][1]) for old, new in names], order if kept else "unsorted", {old: k for k, old in enumerate(old_ids)}, kept


def rename_and_sort(records: DataFrame, sizes: list[tuple[str, int]], order: str, names: list[tuple[str, str]], sort: str = "auto") -> tuple[DataFrame, list[tuple[str, int]], str]:
    """Renamed records (idx, rname, pos ...) with their header; sort is auto (if the order of chromosomes changes), true or false."""
    header, order, _, kept = reheader(sizes, order, names)
    spark = records.sparkSession
    table = spark.createDataFrame([(a, b, k) for k, (a, b) in enumerate(names)], "old string, new string, sort_order int")
    out = rename_chromosomes(records, table)
    if sort == "true" or sort == "auto" and not kept:
        return out.orderBy("sort_order", "pos", "idx"), header, "coordinate"
    return out.orderBy("idx"), header, order


def rename_intervals(intervals: DataFrame, names: DataFrame) -> DataFrame:
    """BED rows of the chromosomes in names, renamed, in the order of names, start and end."""
    return rename_chromosomes(intervals, names, "chrom").orderBy("sort_order", "start", "end").drop("sort_order")


def join_sizes(names: DataFrame, sizes: DataFrame) -> DataFrame:
    """(chrom, length) of names (old, new, sort_order) and sizes (chrom, length), in the order of names."""
    return names.join(sizes.withColumnRenamed("chrom", "old"), "old").orderBy("sort_order").select(F.col("new").alias("chrom"), "length")


def rename_fasta(records: DataFrame, names: DataFrame) -> DataFrame:
    """FASTA records (chrom, seq) of the chromosomes in names (old, new, sort_order), under their new names alone."""
    return rename_chromosomes(records.withColumnRenamed("chrom", "rname"), names).withColumnRenamed("rname", "chrom")


def size_totals(index: DataFrame, names: DataFrame) -> DataFrame:
    """(n_index, bases_index, n_kept, bases_kept): sequences and bases of an index (chrom, length), and of those that names (old) keeps."""
    kept = index.join(names.select(F.col("old").alias("chrom"), F.lit(True).alias("kept")).distinct(), "chrom", "left")
    own = F.col("kept").isNotNull()
    return kept.agg(F.count("*").alias("n_index"), F.sum("length").alias("bases_index"), F.count_if(own).alias("n_kept"), F.sum(F.when(own, F.col("length")).otherwise(0)).alias("bases_kept"))


def version_order(name: Column) -> list[Column]:
    """Sort keys by which chr2 comes before chr10: the letters before the first number, the number, the rest."""
    found = lambda k: F.regexp_extract(name, r"^(\D*)(\d*)(.*)$", k)
    return [found(1), F.coalesce(found(2).try_cast("long"), F.lit(-1)), found(3)]


def mask_chromosomes(mask: DataFrame, known: DataFrame) -> DataFrame:
    """(chrom, n, known) of a mask's chromosomes: those not in known (chrom) are reported; a mask without any known one is an error."""
    counts = mask.groupBy("chrom").agg(F.count("*").alias("n"))
    out = counts.join(known.select("chrom", F.lit(True).alias("known")).distinct(), "chrom", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    if not out.where("known").limit(1).count():
        raise ValueError("the mask has no known chromosome")
    return out
