"""FASTQ, SAM, FASTA and BED as data frames, and back.

SAM and BED lines are read by Spark's text source; FASTQ, pairs and FASTA windows by byte ranges, see ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranges import read_fastq, read_pairs  # noqa: F401

def write_fastq(reads: DataFrame, path: str, by: tuple[str, ...] = (), compression: str = "gzip") -> None:
    """Reads (qname, seq, qual) as FASTQ text, in folders by columns (such as a route)."""
    lines = reads.select(*by, F.concat_ws("\n", F.concat(F.lit("@"), "qname"), "seq", F.lit("+"), "qual").alias("value"))
    writer = lines.write.option("compression", compression)
    (writer.partitionBy(*by) if by else writer).text(path)


SAM = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Records of SAM text: the eleven columns, tags and types map<string,string> (TAG -> value, TAG -> type letter), ref_start, ref_end (half-open)."""
    lines = spark.read.text(path).where("value NOT LIKE '@%' AND value <> ''")
    parts = F.split("value", "\t")
    out = lines.select(*[parts[k].alias(c) for k, c in enumerate(SAM)], F.slice(parts, F.lit(12), F.size(parts)).alias("extra"))
    for c in ("flag", "mapq"):
        out = out.withColumn(c, F.col(c).cast("int"))
    for c in ("pos", "pnext", "tlen"):
        out = out.withColumn(c, F.col(c).cast("long"))
    span = F.aggregate(F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    # Of a tag that a record repeats the first counts.
    parts = F.transform("extra", lambda t: F.split(t, ":", 3))
    own = F.filter(F.transform(parts, lambda t, k: F.struct(t.alias("t"), k.alias("k"))), lambda x: F.array_position(F.transform(parts, lambda t: t[0]), x["t"][0]) == x["k"] + 1)
    field = lambda k: F.map_from_entries(F.transform(own, lambda x: F.struct(x["t"][0], x["t"][k])))
    return out.withColumn("tags", field(2)).withColumn("types", field(1)).drop("extra").withColumn("ref_start", F.col("pos") - 1).withColumn("ref_end", F.col("pos") - 1 + span)


def read_sam_header(spark: SparkSession, path: str) -> DataFrame:
    """(value): the header lines of SAM text."""
    return spark.read.text(path).where("value LIKE '@%'")


def header_sizes(header: DataFrame) -> DataFrame:
    """(chrom, length) of the @SQ lines of a header."""
    return header.where("value LIKE '@SQ\t%'").select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("chrom"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("long").alias("length"))


def sam_lines(records: DataFrame) -> DataFrame:
    """(value): SAM text of records; tags in order of their names, with their types, strings where a type is not known."""
    typed = "types" in records.columns
    tags = F.transform(F.array_sort(F.map_keys("tags")), lambda k: F.concat(k, F.lit(":"), F.coalesce(F.try_element_at("types", k), F.lit("Z")) if typed else F.lit("Z"), F.lit(":"), F.element_at("tags", k)))
    fields = F.concat_ws("\t", *[F.col(c).cast("string") for c in SAM])
    return records.select(F.when(F.size("tags") > 0, F.concat_ws("\t", fields, F.array_join(tags, "\t"))).otherwise(fields).alias("value"))


def write_sam(records: DataFrame, header: list[str], path: str) -> None:
    """SAM text of records; the header lines are the first part, so that the parts in order are one SAM file."""
    lines = sam_lines(records)
    if header:
        lines = records.sparkSession.createDataFrame([(line,) for line in header], "value string").coalesce(1).unionByName(lines)
    lines.write.text(path)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, start, end) of BED text, plain or .gz. Comments, track and browser lines and blank ones are passed over; any other line that is no interval is an error."""
    lines = spark.read.text(path).where("trim(value) <> '' AND NOT value RLIKE '^(#|track|browser)'")
    parts = F.split("value", "\t")
    number = lambda k: F.coalesce(F.get(parts, F.lit(k)).try_cast("long"), F.raise_error(F.concat(F.lit("no BED line: "), "value")).cast("long"))
    return lines.select(parts[0].alias("chrom"), number(1).alias("start"), number(2).alias("end"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, seq) of FASTA text with short records, each as one row: its lines joined; a name ends at white space. For chromosomes take read_fasta_windows."""
    # A record begins at the begin of a line only, so `>` within a description is none.
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).where("trim(value) <> ''")
    lines = F.split("value", "\n", 2)
    return records.select(F.split(lines[0], r"\s+")[0].alias("chrom"), F.regexp_replace(F.coalesce(F.get(lines, F.lit(1)), F.lit("")), r"\s+", "").alias("seq"))


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, length long")


def read_index_summary(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, length) of an aligner's index summary: lines `Sequence-<k>`, name, length; a name ends at white space."""
    found = F.regexp_extract("value", r"^Sequence-\d+\t([^\t\s]+)[^\t]*\t(\d+)", 1), F.regexp_extract("value", r"^Sequence-\d+\t[^\t]*\t(\d+)", 1)
    return spark.read.text(path).where("value LIKE 'Sequence-%'").select(found[0].alias("chrom"), found[1].cast("long").alias("length"))


def write_bed(spans: DataFrame, path: str) -> None:
    """(chrom, start, end) as BED lines."""
    spans.select(F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string")).alias("value")).write.text(path)


def write_fasta(records: DataFrame, path: str, width: int = 60) -> None:
    """(chrom, seq) as FASTA records, `width` letters a line."""
    lines = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    records.select(F.concat(F.lit(">"), "chrom", F.lit("\n"), lines).alias("value")).write.text(path)


def fastq_reads(spark: SparkSession, path: str) -> DataFrame:
    """(n_reads) of FASTQ text: a fourth of its lines, which must be a whole number."""
    lines = spark.read.text(path).agg(F.count("*").alias("n"))
    return lines.select(F.when(F.col("n") % 4 == 0, F.expr("n div 4")).otherwise(F.raise_error(F.concat(F.col("n").cast("string"), F.lit(" lines are no FASTQ"))).cast("long")).alias("n_reads"))


def read_statistics(spark: SparkSession, paths: list[str]) -> DataFrame:
    """TSV tables with headers, with sample: the file's name up to its first dot."""
    return spark.read.csv(paths, sep="\t", header=True, inferSchema=True).withColumn("sample", F.split_part(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.lit("."), F.lit(1)))


def write_bedgraph(cover: DataFrame, bin_size: int, path: str) -> None:
    """Coverage (chrom, bin, value) as bedGraph lines."""
    cover.select("chrom", (F.col("bin") * bin_size).alias("start"), ((F.col("bin") + 1) * bin_size).alias("end"), "value").write.csv(path, sep="\t")


def write_by_target(records: DataFrame, path: str, by: tuple[str, ...] = ("sample", "target"), tie: tuple[str, ...] = ()) -> None:
    """Records as Parquet in folders by target, in the order of chromosomes and positions; null targets have their own folder.

    Tasks take ranges of (target, chromosome, position), by sampled sizes: a large target is written by many tasks, small ones
    share one. Within a folder, files in the order of their names are one order. Where very many records share a position, `tie` names
    columns that tell them apart.
    """
    # A column of one constant would be left out of the order, and the writer then sort again by folders alone; nothing is added to it here, but of a column.
    nothing = F.coalesce(F.substring(F.col("ref_start").cast("string"), 1, 0), F.lit(""))
    records = records.withColumns({c: F.concat(F.col(c).cast("string"), nothing) for c in by})
    order = [*by, "sort_order", "ref_start", *tie]
    records.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy(*by).parquet(path)


def read_target(spark: SparkSession, path: str, **target: str) -> DataFrame:
    """Records of a target (column=value of write_by_target's folders), over all samples unless one is given: only its folders are listed and read."""
    out = spark.read.parquet(path)
    for column, value in target.items():
        out = out.where(F.col(column) == value)
    return out


def write_routed(reads: DataFrame, path: str, skipped: dict[str, Column], rounds: dict[str, list[int]] | None = None, compression: str = "gzip") -> dict[str, int]:
    """Reads (qname, seq, qual) as FASTQ in folders by route, without those that `skipped` names reasons for; returns n_read, n_<reason> and n_written, counted by the job that writes."""
    from ..operators.barcode import route
    from ..operators.stats import observed

    kept, seen = observed(reads, skipped)
    write_fastq(route(kept, rounds), path, ("route",), compression)
    return seen.get


def write_tsv(rows: DataFrame, path: str) -> None:
    """A small table as one gzip TSV file."""
    rows.coalesce(1).write.csv(path, sep="\t", header=True, compression="gzip")
