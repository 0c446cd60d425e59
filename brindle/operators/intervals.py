"""Half-open intervals (chrom, start, end): merging, masking, coverage, masked bases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows up to which a mask is broadcast; a larger one is joined by bins.
SMALL_MASK = 100_000


def merge_intervals(intervals: DataFrame, gap: int = 0, span: int = 1_000_000) -> DataFrame:
    """Intervals of a chrom joined where they overlap or touch (or are at most gap apart).

    Intervals are put in spans by their start. How far those of earlier spans reach is known from one number for each span, so each
    span finds its islands by itself. Only its first, where that goes on from before, and its last one meet those of other spans:
    no task has all intervals, or all islands, of a chrom.
    """
    slim = intervals.select("chrom", "start", "end", F.expr(f"start div {span}").alias("span"))
    ends = slim.groupBy("chrom", "span").agg(F.max("end").alias("far"))
    spans = Window.partitionBy("chrom").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    ordered = Window.partitionBy("chrom", "span").orderBy("start", "end")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    joined = slim.join(ends.select("chrom", "span", F.max("far").over(spans).alias("far")), ["chrom", "span"])
    fresh = joined.withColumn("new", F.coalesce((F.col("start") > F.greatest("far", before) + gap).cast("int"), F.lit(1)))
    islands = fresh.withColumn("island", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    own = islands.groupBy("chrom", "span", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    own = own.withColumn("last", F.max("island").over(Window.partitionBy("chrom", "span")))
    # Island 0 of a span goes on from before; with it, only last ones can be continued.
    edge = (F.col("island") == 0) | (F.col("island") == F.col("last"))
    chain = F.sum((F.col("island") > 0).cast("int")).over(Window.partitionBy("chrom").orderBy("span", "island").rowsBetween(Window.unboundedPreceding, 0))
    across = own.where(edge).withColumn("chain", chain).groupBy("chrom", "chain").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return own.where(~edge).select("chrom", "start", "end").unionByName(across.select("chrom", "start", "end"))


def mask(reads: DataFrame, intervals: DataFrame, keep: str = "outside", bin_size: int = 10_000) -> DataFrame:
    """Reads (chrom, start, end) that overlap none of the intervals (keep="outside") or at least one ("inside").

    The mask is counted first: one of SMALL_MASK rows or fewer is broadcast; a larger one, and the reads, are dealt out by bins of
    the chrom, and the reads that meet an interval are matched by their rows' numbers. In both, a read and an interval overlap if each
    starts before the other's end, so an empty one overlaps what it lies within.
    """
    how = {"outside": "left_anti", "inside": "left_semi"}[keep]
    m = intervals.select(F.col("chrom").alias("m_chrom"), F.col("start").alias("m_start"), F.col("end").alias("m_end"))
    meet = (F.col("chrom") == F.col("m_chrom")) & (F.col("start") < F.col("m_end")) & (F.col("m_start") < F.col("end"))
    if m.limit(SMALL_MASK + 1).count() <= SMALL_MASK:
        return reads.join(F.broadcast(m), meet, how)
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / bin_size), F.floor(F.greatest(F.col(b) - 1, F.col(a)) / bin_size)))
    spans = reads.select("chrom", "start", "end").distinct().withColumn("bin", bins("start", "end"))
    hits = spans.join(m.withColumn("m_bin", bins("m_start", "m_end")), meet & (F.col("bin") == F.col("m_bin"))).select("chrom", "start", "end").distinct()
    return reads.join(hits, ["chrom", "start", "end"], how)


def coverage(reads: DataFrame, bin_size: int, by: tuple[str, ...] = (), normalize: str | None = None, effective_size: float | None = None, fragment_length: float | None = None) -> DataFrame:
    """(by, chrom, bin, n, value): reads that touch each bin. normalize: None, CPM, RPKM, BPM or RPGC."""
    bins = F.explode(F.sequence(F.expr(f"start div {bin_size}"), F.expr(f"(end - 1) div {bin_size}")))
    counts = reads.where("start < end").select(*by, "chrom", bins.alias("bin")).groupBy(*by, "chrom", "bin").agg(F.count("*").alias("n"))
    if normalize is None:
        return counts.withColumn("value", F.col("n").cast("double"))
    if normalize == "BPM":
        totals = counts.groupBy(*by).agg(F.sum("n").alias("all"))
    else:
        totals = reads.groupBy(*by).agg(F.count("*").alias("all"))
    joined = counts.join(F.broadcast(totals), list(by)) if by else counts.crossJoin(F.broadcast(totals))
    cpm = F.col("n") * 1e6 / F.col("all")
    if normalize in ("CPM", "BPM"):
        value = cpm
    elif normalize == "RPKM":
        value = cpm / (bin_size / 1000)
    elif normalize == "RPGC":
        value = F.col("n") / (F.col("all") * float(fragment_length) / float(effective_size))
    else:
        raise ValueError(f"unknown normalisation {normalize!r}")
    return joined.withColumn("value", value).drop("all")


def with_empty(cover: DataFrame, chroms: DataFrame) -> DataFrame:
    """cover with a zero row (bin 0) for each chrom that has no reads."""
    return chroms.select("chrom").distinct().join(cover, "chrom", "left").withColumn("bin", F.coalesce("bin", F.lit(0))).withColumn("n", F.coalesce("n", F.lit(0))).withColumn("value", F.coalesce("value", F.lit(0.0)))


def unmasked_bases(sequences: DataFrame, column: str = "seq", alphabet: str = "ACGT") -> DataFrame:
    """The number of characters of the alphabet in all sequences, case-sensitive."""
    return sequences.agg(F.coalesce(F.sum(F.length(column) - F.length(F.translate(column, alphabet, ""))), F.lit(0)).alias("n_bases"))


def hard_mask(lines: DataFrame, intervals: DataFrame, bin_size: int = 10_000) -> DataFrame:
    """FASTA lines (chrom, offset, seq) with N where an interval covers a base; lines and intervals meet by bins of the chrom."""
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / bin_size), F.floor(F.greatest(b - 1, a) / bin_size))).alias("bin")
    m = merge_intervals(intervals).select("chrom", F.col("start").alias("m_start"), F.col("end").alias("m_end"), bins(F.col("start"), F.col("end")))
    placed = lines.select("chrom", "offset", F.length("seq").alias("n"), bins(F.col("offset"), F.col("offset") + F.length("seq")))
    near = placed.join(m, ["chrom", "bin"]).where((F.col("m_start") < F.col("offset") + F.col("n")) & (F.col("m_end") > F.col("offset")))
    spans = near.groupBy("chrom", "offset").agg(F.array_sort(F.collect_set(F.struct("m_start", "m_end"))).alias("spans"))
    low = lambda s: F.greatest(s["m_start"] - F.col("offset"), F.lit(0))
    width = lambda s: (F.least(s["m_end"] - F.col("offset"), F.length("seq")) - low(s)).cast("int")
    cut = F.aggregate("spans", F.col("seq"), lambda seq, s: F.overlay(seq, F.repeat(F.lit("N"), width(s)), (low(s) + 1).cast("int")))
    return lines.join(spans, ["chrom", "offset"], "left").select("chrom", "offset", F.when(F.col("spans").isNull(), F.col("seq")).otherwise(cut).alias("seq"))
