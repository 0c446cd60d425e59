"""Registered queries of single reads: names without barcodes, adapters with edits, unmapped reads, de-duplication of a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pseudo_dna
from ..operators import barcode, clusters, dedup, trim
from .catalog import _DNA, _ORDER, _reads, _READS_SQL, _clusters, _table, query

# Names of which some carry no barcode, or one of another type.

_ODD = """odd AS (SELECT l_orderkey, l_linenumber, 'r' || l_orderkey || CASE WHEN l_linenumber % 5 = 0 THEN '[DPM1][Y1]' WHEN l_linenumber % 5 = 1 THEN '::[RPM][Y' || (l_suppkey % 10) || '] 1:N'
 WHEN l_linenumber % 5 = 2 THEN '::[BEAD_A]' ELSE '::[DPM' || (l_partkey % 3) || '][Y' || (l_suppkey % 10) || '] 1:N' END AS qname FROM lineitem)"""


def _odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, s = F.col("l_linenumber") % 5, lambda c: F.col(c).cast("string")
    y = F.concat(F.lit("][Y"), (F.col("l_suppkey") % 10).cast("string"), F.lit("] 1:N"))
    behind = F.when(line == 0, "[DPM1][Y1]").when(line == 1, F.concat(F.lit("::[RPM"), y)).when(line == 2, "::[BEAD_A]").otherwise(F.concat(F.lit("::[DPM"), (F.col("l_partkey") % 3).cast("string"), y))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("r"), s("l_orderkey"), behind).alias("qname"))


@query(f"WITH {_ODD} SELECT l_orderkey, l_linenumber, regexp_replace(qname, '::\\[[^\\]]*\\]\\[[^\\]]*\\]', '') AS qname, regexp_extract(qname, '::\\[([^\\]]*)\\]', 1) AS RT, regexp_extract(qname, '\\[(Y\\d)\\]', 1) || '.s' AS CB, 'v:w' AS XX FROM odd WHERE l_linenumber % 5 > 2")
def barcode_names_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcode.barcode_to_tags(_odd(spark, sf_dir), 2, sample="s", add_tags=["XX:Z:v:w"])


@query(f"WITH {_ODD}, t AS (SELECT len(regexp_extract_all(qname, '\\[[^\\]]*\\]'))::INT AS n_found FROM odd) SELECT n_found, count(*) AS n_reads, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM t GROUP BY n_found")
def efficiency_without_barcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcode.tags_found(_odd(spark, sf_dir))


# Oligos of another type stay in no output.


@query(f"WITH {_READS_SQL} SELECT event_id, r.cluster, CASE WHEN target IS NULL THEN label END AS RG, CASE WHEN target IS NOT NULL THEN label END AS YG FROM reads r JOIN clusters c ON r.cluster = c.cluster WHERE coalesce(target, '') <> 'view'")
def labels_skip_other_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _reads(spark, sf_dir)
    odd = reads.withColumn("read_type", F.when(F.col("read_type") == "BEAD_view", "RPM").otherwise(F.col("read_type")))
    return clusters.label_reads(odd, _clusters(spark, sf_dir)).select("event_id", "cluster", "RG", "YG")


# Adapters planted in pseudo-DNA with up to two edits.

_THREE, _FIVE = ("GATCGGAAGAG", "ATCAGCACTTA"), ("TGGGTGTTTTCC", "TCGAGTCTTT")


def _planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' bases with an adapter behind (or before) them: whole, with a letter changed, missing or added, with two edits, or cut by the read's end."""
    dna, k = pseudo_dna(F.col("c_name")), F.col("c_custkey") % 9
    three = F.lit(_THREE[0]), F.lit("GATCGCAAGAG"), F.lit("GATCGAAGAG"), F.lit("GATCGGTAAGAG"), F.lit("GATCCCAAGAG"), F.lit(_THREE[0][:5]), F.lit(""), F.lit(_THREE[1])
    behind = F.element_at(F.array(*three, F.lit("")), (k + 1).cast("int"))
    seq = F.when(k == 8, F.concat(F.lit(_FIVE[0]), dna)).when(k == 6, F.concat(F.lit(_FIVE[1][4:]), dna)).when(k == 5, F.concat(dna, behind)).otherwise(F.concat(F.substring(dna, 1, 24), behind, F.substring(dna, 25, 8)))
    return _table(spark, sf_dir, "customer").select("c_custkey", seq.alias("seq"))


_PLANTED = f"""d AS (SELECT c_custkey, c_custkey % 9 AS k, {_DNA.format('c_name')} AS dna FROM customer),
 r AS (SELECT c_custkey, CASE k WHEN 8 THEN '{_FIVE[0]}' || dna WHEN 6 THEN '{_FIVE[1][4:]}' || dna WHEN 5 THEN dna || 'GATCG' ELSE dna[1:24] ||
 (['{_THREE[0]}', 'GATCGCAAGAG', 'GATCGAAGAG', 'GATCGGTAAGAG', 'GATCCCAAGAG', '', '', '{_THREE[1]}'])[k + 1] || dna[25:32] END AS seq FROM d)"""


@query(f"""WITH {_PLANTED}, a AS (SELECT unnest(['{_THREE[0]}', '{_THREE[1]}', '{_FIVE[0]}', '{_FIVE[1]}']) AS adapter, unnest([0, 1, 2, 3]) AS place, unnest([false, false, true, true]) AS five),
 p AS (SELECT c_custkey, seq, length(seq) AS n, adapter, place, five, length(adapter) AS m, CASE WHEN five THEN reverse(seq) ELSE seq END AS t, CASE WHEN five THEN reverse(adapter) ELSE adapter END AS x FROM r, a),
 -- every start, every length within the edits, whole adapters anywhere and prefixes at the end
 w AS (SELECT *, unnest(range(n)) AS s FROM p), v AS (SELECT *, unnest(range(least(n - s, m + 1) + 1)) AS l FROM w),
 whole AS (SELECT c_custkey, seq, n, adapter, place, five, s, m AS i, levenshtein(x, t[s + 1:s + l]) AS d FROM v WHERE l >= m - 1),
 cut AS (SELECT c_custkey, seq, n, adapter, place, five, s, i, levenshtein(x[1:i], t[s + 1:]) AS d FROM (SELECT *, unnest(range(3, m)) AS i FROM w WHERE n - s <= m) WHERE abs(n - s - i) <= 1),
 found AS (SELECT * FROM (SELECT * FROM whole UNION ALL SELECT * FROM cut) WHERE d <= floor(i * 0.1)),
 best AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY i - 2 * d DESC, place, s) AS k FROM found)
 SELECT r.c_custkey, adapter, CASE WHEN place IS NULL THEN r.seq WHEN five THEN r.seq[n - s + 1:] ELSE r.seq[1:s] END AS seq FROM r LEFT JOIN (SELECT * FROM best WHERE k = 1) b ON r.c_custkey = b.c_custkey
 WHERE length(CASE WHEN place IS NULL THEN r.seq WHEN five THEN r.seq[n - s + 1:] ELSE r.seq[1:s] END) >= 20""")
def adapter_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _planted(spark, sf_dir).withColumn("qual", F.repeat(F.lit("I"), F.length("seq")))
    return trim.trim_adapters(reads, _THREE, _FIVE, found="adapter").select("c_custkey", "adapter", "seq")


@query(f"WITH {_PLANTED} SELECT c_custkey, CASE WHEN starts_with(seq, 'TGGGTGTTT') THEN seq[10:] WHEN starts_with(seq, 'GTCTTT') THEN seq[7:] ELSE seq END AS seq FROM r")
def anchored_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _planted(spark, sf_dir).withColumn("qual", F.col("seq"))
    return trim.trim_anchored(reads, ["TGGGTGTTT", "GTCTTT"]).select("c_custkey", "seq")


# De-duplication.


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN '*' ELSE l_linestatus END AS rname, CASE WHEN l_linenumber IN (6, 7) THEN -1 ELSE l_suppkey END AS s, l_returnflag FROM lineitem)
 SELECT rname, s AS ref_start, l_returnflag, min(l_orderkey * 10 + l_linenumber) AS first, count(*) AS dc FROM r WHERE rname <> '*' AND s >= 0 GROUP BY ALL UNION ALL SELECT rname, s, l_returnflag, l_orderkey * 10 + l_linenumber, 1 FROM r WHERE rname = '*' OR s < 0""")
def dedup_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 7, "*").otherwise(F.col("l_linestatus")).alias("rname"),
        F.when(F.col("l_linenumber").isin(6, 7), -1).otherwise(F.col("l_suppkey")).cast("long").alias("ref_start"),
        "l_returnflag", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("first"),
    )
    return dedup.deduplicate(reads, "start", ("l_returnflag",), ("first",))


@query("""WITH RECURSIVE r AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem),
 p(i, supps, parts) AS (SELECT i, [l_suppkey], [l_partkey] FROM r WHERE i = 1 UNION ALL
  SELECT arg_min(r.i, r.i), list_append(any_value(p.supps), arg_min(r.l_suppkey, r.i)), list_append(any_value(p.parts), arg_min(r.l_partkey, r.i))
  FROM p JOIN r ON r.i > p.i AND NOT list_contains(p.supps, r.l_suppkey) AND NOT list_contains(p.parts, r.l_partkey) HAVING count(*) > 0),
 k AS (SELECT r.* FROM r JOIN p USING (i)),
 c AS (SELECT r.i, coalesce(CASE WHEN s.i <= r.i THEN s.i END, CASE WHEN q.i <= r.i THEN q.i END) AS owner FROM r LEFT JOIN k s ON s.l_suppkey = r.l_suppkey LEFT JOIN k q ON q.l_partkey = r.l_partkey)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) AS dc FROM c JOIN k ON c.owner = k.i GROUP BY ALL""")
def dedup_or_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", *_ORDER)
    # The two columns are alternatives of their own: equal numbers of both are no common key.
    marked = lines.withColumn("supp", F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).withColumn("part", F.concat(F.lit("p"), F.col("l_partkey").cast("string")))
    return dedup.deduplicate(marked, "supp|part", (), ("l_orderkey", *_ORDER)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "dc")


@query(f"WITH {_ODD} SELECT unnest(['dpm', 'bpm', 'none']) AS kind, unnest([count(*) FILTER (l_linenumber % 5 > 2), 0, 0]) AS n FROM odd")
def counts_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = barcode.barcode_to_tags(_odd(spark, sf_dir), 2)
    return clusters.counts_by_type(tagged, {"dpm": "^DPM", "bpm": "^BEAD", "none": "^none"})
