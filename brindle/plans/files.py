"""Registered queries that go through files: FASTQ and pairs by ranges, FASTA windows to masks, BAM."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import streaming
from ..functions import pseudo_dna
from ..operators import barcode, funnel, intervals
from ..sources import bam, bigwig, folder, ranges, text
from .catalog import _COVER, _DNA, _cte, _reads, _spans, _table, query
from .reads import _ODD, _odd

# Ranges are small here, so that the given tables' files have several; where the work follows the tables' size, they grow with the files.
_SPLIT = 1 << 14


def _fastq(spark: SparkSession, sf_dir: str, seq) -> str:
    path = folder.fresh(spark, "fastq")
    reads = _table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(" x")).alias("qname"), seq.alias("seq"))
    # Qualities of @ and + are what makes the begin of a record hard to find.
    text.write_fastq(reads.withColumn("qual", F.translate("seq", "ACGT", "@+I#")), path, compression="none")
    return path


@query(f"SELECT 'c' || c_custkey || ' x' AS qname, {_DNA.format('c_name')} AS seq, translate({_DNA.format('c_name')}, 'ACGT', '@+I#') AS qual FROM customer")
def fastq_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.read_fastq(spark, _fastq(spark, sf_dir, pseudo_dna(F.col("c_name"))), split=_SPLIT).select("qname", "seq", "qual")


@query(f"SELECT 'c' || c_custkey || ' x' AS qname, {_DNA.format('c_name')} AS seq1, {_DNA.format('c_name')}[1:20] AS seq2 FROM customer")
def fastq_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    dna = pseudo_dna(F.col("c_name"))
    one, two = _fastq(spark, sf_dir, dna), _fastq(spark, sf_dir, F.substring(dna, 1, 20))
    return ranges.read_pairs(spark, [one], [two], split=_SPLIT).select("qname", "seq1", "seq2")


@query(f"""WITH c AS (SELECT c_custkey::VARCHAR AS chrom, repeat({_DNA.format('c_name')}, 40) AS seq, (c_nationkey * 37 + 20)::BIGINT AS s FROM customer),
 m AS (SELECT chrom, seq[1:s] || repeat('N', least(100, 1280 - s)) || seq[s + 101:] AS seq FROM c), b AS (SELECT chrom, unnest(range(5)) AS block, seq FROM m)
 SELECT chrom, block, length(replace(seq[block * 256 + 1:(block + 1) * 256], 'N', ''))::BIGINT AS n_bases, length(replace(replace(replace(replace(seq[block * 256 + 1:(block + 1) * 256], 'N', ''), 'C', ''), 'G', ''), 'T', ''))::BIGINT AS n_a FROM b""")
def fasta_hard_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FASTA written, read in windows, masked by intervals, and the bases left counted by blocks of 256."""
    path, customers = folder.fresh(spark, "fasta"), _table(spark, sf_dir, "customer")
    chrom, start = F.col("c_custkey").cast("string").alias("chrom"), F.col("c_nationkey") * 37 + 20
    text.write_fasta(customers.select(chrom, F.repeat(pseudo_dna(F.col("c_name")), F.lit(40)).alias("seq")), path)
    mask = customers.select(chrom, start.cast("long").alias("start"), (start + 100).cast("long").alias("end"))
    masked = intervals.hard_mask(ranges.read_fasta_windows(spark, path, window=256, split=ranges.split_for(spark, path, least=_SPLIT)), mask)
    bases = lambda letters: F.sum(F.length("seq") - F.length(F.translate("seq", letters, ""))).alias("n_a" if letters == "A" else "n_bases")
    return masked.groupBy("chrom", F.expr("offset div 256").alias("block")).agg(bases("ACGT"), bases("A"))


@query(f"SELECT count(*) * 32 - sum(length({_DNA.format('c_name')}) - length(replace({_DNA.format('c_name')}, 'T', '')))::BIGINT AS n_bases FROM customer")
def fasta_unmasked_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bases of FASTA windows in which T is masked."""
    path = folder.fresh(spark, "fasta")
    text.write_fasta(_table(spark, sf_dir, "customer").select(F.concat(F.col("c_custkey").cast("string"), F.lit(" a>b")).alias("chrom"), F.translate(pseudo_dna(F.col("c_name")), "T", "N").alias("seq")), path, 10)
    return intervals.unmasked_bases(ranges.read_fasta_windows(spark, path, split=_SPLIT))


@query("""SELECT 'r' || l_orderkey || '.' || l_linenumber AS qname, l_linenumber::INT AS flag, CASE WHEN l_linenumber = 7 THEN '*' ELSE l_returnflag END AS rname, CASE WHEN l_linenumber = 7 THEN 0 ELSE l_suppkey END::BIGINT AS pos, l_quantity::INT AS mapq,
 l_linenumber || 'M2D1S' AS cigar, 'ACGTN' AS seq, 'IIII#' AS qual, CASE WHEN l_linenumber = 7 THEN -1 ELSE l_suppkey - 1 END::BIGINT AS ref_start, (CASE WHEN l_linenumber = 7 THEN -1 ELSE l_suppkey - 1 END + l_linenumber + 2)::BIGINT AS ref_end, l_partkey::VARCHAR AS nm, 'iZ' AS kinds, l_linestatus AS rt FROM lineitem""")
def bam_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as records, written as BAM by every task and read by ranges of blocks."""
    star, none, unmapped = F.lit("*"), F.lit(0).cast("long"), F.col("l_linenumber") == 7
    records = _table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string")).alias("qname"), F.col("l_linenumber").cast("int").alias("flag"),
        F.when(unmapped, "*").otherwise(F.col("l_returnflag")).alias("rname"), F.when(unmapped, 0).otherwise(F.col("l_suppkey")).cast("long").alias("pos"), F.col("l_quantity").cast("int").alias("mapq"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("M2D1S")).alias("cigar"), star.alias("rnext"), none.alias("pnext"), none.alias("tlen"), F.lit("ACGTN").alias("seq"), F.lit("IIII#").alias("qual"),
        F.create_map(F.lit("NM"), F.col("l_partkey").cast("string"), F.lit("RT"), "l_linestatus").alias("tags"), F.create_map(F.lit("NM"), F.lit("i"), F.lit("RT"), F.lit("Z")).alias("types"),
    )
    path = folder.fresh(spark, "bam")
    bam.write_bam(records, ["@HD\tVN:1.6", *(f"@SQ\tSN:{name}\tLN:1000000" for name in "ANR")], path)
    back = bam.read_bam(spark, path, split=ranges.split_for(spark, path, least=_SPLIT))
    kinds = F.concat(F.element_at("types", "NM"), F.element_at("types", "RT"))
    return back.select("qname", "flag", "rname", "pos", "mapq", "cigar", "seq", "qual", "ref_start", "ref_end", F.element_at("tags", "NM").alias("nm"), kinds.alias("kinds"), F.element_at("tags", "RT").alias("rt"))


# Coverage by day as bigWig; a chromosome without reads, and of reads without coverage, has a track of zeros.


def _bigwig(spark: SparkSession, sf_dir: str) -> str:
    cover = intervals.coverage(_spans(spark, sf_dir), 30).select("chrom", (F.col("bin") * 30).alias("start"), ((F.col("bin") + 1) * 30).alias("end"), "value")
    sizes = _table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("chrom"), F.lit(30_000).cast("long").alias("length")).distinct()
    path = f"{folder.fresh(spark, 'cover')}.bw"
    bigwig.write_bigwig(cover, sizes, path, 30)
    return path


_BIGWIG = f"""{_COVER}, c AS (SELECT chrom, bin * 30 AS s, sum(n)::DOUBLE AS value FROM bins GROUP BY chrom, bin),
 w AS (SELECT chrom, s, s + 30 AS e, value FROM c UNION ALL SELECT DISTINCT o_orderstatus, 0, 30000, 0 FROM orders WHERE o_orderstatus NOT IN (SELECT chrom FROM c))"""


@query(f'WITH {_BIGWIG} SELECT chrom, s AS "start", e AS "end", value FROM w')
def bigwig_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bigwig.read_bigwig(spark, _bigwig(spark, sf_dir))


@query(f"""WITH {_BIGWIG}, z AS (SELECT chrom, value, unnest(range(s // 1920, (e - 1) // 1920 + 1)) AS bin, s, e FROM w), y AS (SELECT *, least(e, bin * 1920 + 1920) - greatest(s, bin * 1920) AS n FROM z)
 SELECT chrom, min(greatest(s, bin * 1920)) AS "start", max(least(e, bin * 1920 + 1920)) AS "end", sum(n)::BIGINT AS valid, min(value) AS least, max(value) AS most, sum(n * value)::FLOAT::DOUBLE AS sum FROM y GROUP BY chrom, bin""")
def bigwig_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bigwig.read_bigwig(spark, _bigwig(spark, sf_dir), zoom=30 * 64).drop("squares")


# Labels kept up to date over a stream; counters of the job that writes; targets of very different sizes.


@query(_cte("SELECT cluster, n_dpm, n_oligo, mode, mode_count, label FROM clusters"))
def streaming_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads arrive in four batches; after each, the clusters that it touched are labelled again."""
    arriving, state = folder.fresh(spark, "arriving"), folder.fresh(spark, "labels")
    _reads(spark, sf_dir).select("cluster", "read_type", F.col("event_id")).repartition(4, "event_id").write.parquet(arriving)
    labels = streaming.ClusterLabels(spark, state, min_oligos=2, proportion=0.8, max_size=2)
    stream = spark.readStream.schema("cluster string, read_type string, event_id long").option("maxFilesPerTrigger", 1).parquet(arriving)
    labels.run(stream, f"{state}/checkpoint").awaitTermination()
    return labels.labels().select("cluster", "n_dpm", "n_oligo", "mode", "mode_count", "label")


@query(f"""WITH {_ODD} SELECT count(*) AS n_read, count(*) FILTER (l_linenumber % 5 IN (0, 2)) AS n_no_barcode, count(*) FILTER (l_linenumber % 5 = 1) AS n_other_type, count(*) FILTER (l_linenumber % 5 > 2) AS n_written FROM odd""")
def observed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A routed write of FASTQ, which counts what it reads, skips and writes."""
    reads = _odd(spark, sf_dir).select("qname", F.lit("ACGT").alias("seq"), F.lit("IIII").alias("qual"))
    found = text.write_routed(reads, folder.fresh(spark, "routed"), barcode.barcode_faults(2))
    return spark.createDataFrame([tuple(found[c] for c in ("n_read", "n_no_barcode", "n_other_type", "n_written"))], "n_read long, n_no_barcode long, n_other_type long, n_written long")


@query("SELECT l_returnflag AS target, count(*) AS n, sum(l_suppkey)::BIGINT AS total, true AS in_order FROM lineitem GROUP BY 1")
def files_by_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written by target and read in the order of files: positions never go back from a file to the next."""
    records = _table(spark, sf_dir, "lineitem").select(F.lit("s").alias("sample"), F.col("l_returnflag").alias("target"), F.col("l_linenumber").alias("sort_order"), F.col("l_suppkey").alias("ref_start"), "l_orderkey")
    path = folder.fresh(spark, "targets")
    text.write_by_target(records, path, tie=("l_orderkey",))
    place = F.struct("sort_order", "ref_start", "l_orderkey")
    ends = spark.read.parquet(path).groupBy("target", F.col("_metadata.file_name").alias("file")).agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("n"), F.sum("ref_start").alias("total"))
    before = F.lag("high").over(Window.partitionBy("target").orderBy("file"))
    return ends.withColumn("ordered", F.coalesce(before <= F.col("low"), F.lit(True))).groupBy("target").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.bool_and("ordered").alias("in_order"))


@query("""WITH RECURSIVE t AS (SELECT o_orderkey AS node, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS up FROM orders),
 r(node, root, depth) AS (SELECT node, node, 0::BIGINT FROM t WHERE up IS NULL UNION ALL SELECT t.node, r.root, r.depth + 1 FROM t JOIN r ON t.up = r.node) SELECT * FROM r""")
def level_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's first order of its customer, and how many lie before it, by the table of previous orders."""
    up = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return funnel.closure(_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("node"), up.alias("up")), "node", "up")
