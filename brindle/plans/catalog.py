"""The registered queries of the engine over the given tables, each with the SQL that gives the same rows.

Tables are seen as reads: events are reads of clusters (a user's day), clicks are chromatin and other types name targets;
line items are reads of orders, and intervals of days; names of customers and suppliers give stable pseudo-DNA.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import day_number, hamming, pseudo_dna
from ..operators import barcode, chrom, clusters, dedup, funnel, interactions, intervals, stats
from ..sources import folder, text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Reads of clusters, from events.


def _reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", "DPM1").otherwise(F.concat(F.lit("BEAD_"), "event_type"))
    cluster = F.concat_ws("_", F.col("user_id").cast("string"), day_number(F.col("ts")).cast("string"))
    return _table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 4).alias("sample"), cluster.alias("cluster"), kind.alias("read_type"))


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.summarize_clusters(_reads(spark, sf_dir), min_oligos=2, proportion=0.8, max_size=2)


_READS_SQL = """reads AS (SELECT event_id, user_id % 4 AS sample, user_id || '_' || date_diff('day', DATE '1970-01-01', ts::DATE) AS cluster,
 CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS target FROM events),
counts AS (SELECT cluster, target, count(*) AS n FROM reads GROUP BY ALL),
sums AS (SELECT cluster, coalesce(sum(n) FILTER (target IS NULL), 0)::BIGINT AS n_dpm, coalesce(sum(n) FILTER (target IS NOT NULL), 0)::BIGINT AS n_oligo,
 coalesce(max(n) FILTER (target IS NOT NULL), 0)::BIGINT AS mode_count FROM counts GROUP BY cluster),
modes AS (SELECT c.cluster, min(c.target) AS mode FROM counts c JOIN sums s ON c.cluster = s.cluster AND c.n = s.mode_count WHERE c.target IS NOT NULL GROUP BY c.cluster),
clusters AS (SELECT s.*, m.mode, CASE WHEN n_oligo = 0 THEN 'none' WHEN n_dpm > 2 THEN 'filtered' WHEN mode_count < 2 THEN 'uncertain'
 WHEN mode_count / n_oligo < 0.8 THEN 'ambiguous' ELSE mode END AS label FROM sums s LEFT JOIN modes m USING (cluster))"""


def _cte(sql: str, *more: str) -> str:
    return f"WITH {', '.join((_READS_SQL, *more))} {sql}"


@query(_cte("SELECT label, count(*) AS n_clusters, sum(n_dpm)::BIGINT AS n_dpm FROM clusters GROUP BY label"))
def cluster_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clusters(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n_clusters"), F.sum("n_dpm").alias("n_dpm"))


@query(_cte("SELECT cluster, n_dpm, n_oligo, mode, mode_count, round(CASE WHEN n_oligo > 0 THEN mode_count / n_oligo ELSE 0 END, 6)::DOUBLE AS share, label FROM clusters"))
def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clusters(spark, sf_dir).withColumn("share", F.round("share", 6)).select("cluster", "n_dpm", "n_oligo", "mode", "mode_count", "share", "label")


_HIST = "hist AS (SELECT label, unnest(['total', 'DPM', 'BPM']) AS read_type, unnest([n_dpm + n_oligo, n_dpm, n_oligo]) AS reads_per_cluster FROM clusters)"


@query(_cte("SELECT label, read_type, reads_per_cluster, count(*) AS n_clusters FROM hist GROUP BY ALL", _HIST))
def reads_per_cluster_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.reads_per_cluster(_clusters(spark, sf_dir))


@query(_cte("SELECT label, metric, value, count(*) AS n_clusters FROM (SELECT label, unnest(['count', 'proportion']) AS metric, unnest([mode_count::BIGINT, CASE WHEN n_oligo > 0 THEN round(100 * round_even(mode_count / n_oligo, 2))::BIGINT ELSE 0 END]) AS value FROM clusters) GROUP BY ALL"))
def bpm_max_rep_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.max_representation(_clusters(spark, sf_dir))


@query(_cte("SELECT event_id, r.cluster, CASE WHEN target IS NULL THEN label END AS RG, CASE WHEN target IS NOT NULL THEN label END AS YG, CASE WHEN target IS NOT NULL THEN n_dpm END AS YC FROM reads r JOIN clusters c ON r.cluster = c.cluster"))
def labelled_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.label_reads(_reads(spark, sf_dir), _clusters(spark, sf_dir)).select("event_id", "cluster", "RG", "YG", "YC")


@query(_cte("SELECT sample, label, count(*) AS n_reads FROM reads r JOIN clusters c ON r.cluster = c.cluster WHERE target IS NULL GROUP BY ALL"))
def label_read_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.label_reads(_reads(spark, sf_dir), _clusters(spark, sf_dir)).where("RG IS NOT NULL").groupBy("sample", F.col("RG").alias("label")).agg(F.count("*").alias("n_reads"))


@query(_cte("SELECT label, count(*) AS n_clusters, sum(n_dpm)::BIGINT AS n_dpm, sum(n_oligo)::BIGINT AS n_oligo, round(avg(n_dpm), 6) AS dpm_per_cluster, round(avg(n_oligo), 6) AS oligo_per_cluster FROM clusters GROUP BY label"))
def counts_per_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.counts_per_label(_clusters(spark, sf_dir))


@query(_cte("SELECT count(*) AS n_clusters, count(*) FILTER (n_oligo = 0) AS without_oligos, count(*) FILTER (n_dpm = 0) AS without_chromatin, count(*) FILTER (n_dpm > 0 AND n_oligo > 0) AS with_both FROM clusters"))
def cluster_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_totals(_clusters(spark, sf_dir))


@query(_cte("""SELECT round(avg((mode_count < n_oligo)::INT), 6) AS mixed_clusters, round(avg((mode_count / n_oligo < 0.8)::INT), 6) AS below_clusters,
 round(sum(n_dpm) FILTER (mode_count < n_oligo) / sum(n_dpm), 6) AS mixed_chromatin, round(sum(n_dpm) FILTER (mode_count / n_oligo < 0.8) / sum(n_dpm), 6) AS below_chromatin FROM clusters WHERE n_oligo > 0"""))
def mixed_cluster_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.mixed_share(_clusters(spark, sf_dir))


@query(_cte("""SELECT t.target, count(*) FILTER (n = n_oligo) AS unique_clusters, count(*) FILTER (n <> n_oligo) AS mixed_clusters, coalesce(sum(n_dpm) FILTER (n = n_oligo), 0)::BIGINT AS unique_dpm,
 coalesce(sum(n_dpm) FILTER (n <> n_oligo), 0)::BIGINT AS mixed_dpm FROM counts t JOIN clusters c ON t.cluster = c.cluster WHERE t.target IS NOT NULL AND label = 'uncertain' GROUP BY t.target"""))
def uncertain_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.uncertain_targets(_reads(spark, sf_dir), _clusters(spark, sf_dir))


@query(_cte("SELECT signature, count(*) AS n_clusters, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM (SELECT cluster, string_agg(n::VARCHAR, ',' ORDER BY n) AS signature FROM counts WHERE target IS NOT NULL GROUP BY cluster) GROUP BY signature"))
def count_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.count_signatures(_reads(spark, sf_dir))


@query(_cte("SELECT sum(n_dpm)::BIGINT AS n_dpm, count(*) AS n_clusters FROM clusters JOIN (SELECT cluster, string_agg(n::VARCHAR, ',' ORDER BY n) AS signature FROM counts WHERE target IS NOT NULL GROUP BY cluster) USING (cluster) WHERE signature = '1,3'"))
def signature_chromatin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.signature_chromatin(_reads(spark, sf_dir), _clusters(spark, sf_dir), "1,3")


@query(_cte("SELECT cluster, n_dpm, n_oligo, mode_count FROM clusters WHERE n_dpm > 0 AND n_dpm <= 200 AND mode_count >= 2 AND mode_count >= 0.1 * n_oligo AND n_oligo <= 30"))
def interacting_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.interacting(_clusters(spark, sf_dir)).select("cluster", "n_dpm", "n_oligo", "mode_count")


@query(_cte("SELECT cluster FROM (SELECT cluster, n, sum(n) OVER (PARTITION BY cluster) AS total FROM counts WHERE target IS NOT NULL) GROUP BY cluster HAVING count(*) FILTER (n >= 2) >= 2 AND count(*) FILTER (n >= 0.1 * total) >= 2"))
def multi_target_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.multi_target(clusters.target_counts(_reads(spark, sf_dir))).select("cluster")


@query(_cte("""SELECT a.target, round(b / tb - a / ta, 6) AS change FROM (SELECT *, sum(b) OVER () AS tb, sum(a) OVER () AS ta FROM
 (SELECT target, sum(n) AS b, sum(n) FILTER (label = 'uncertain') AS a FROM counts JOIN clusters USING (cluster) WHERE target IS NOT NULL GROUP BY target) WHERE a IS NOT NULL) a"""))
def representation_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = clusters.target_counts(_reads(spark, sf_dir)).join(_clusters(spark, sf_dir).select("cluster", "label"), "cluster")
    before = counts.groupBy("target").agg(F.sum("n").alias("n"))
    return clusters.representation_change(before, counts.where("label = 'uncertain'").groupBy("target").agg(F.sum("n").alias("n")))


@query(_cte("SELECT user_mod AS sample, round(coalesce(sum(n_dpm) FILTER (label NOT IN ('none', 'filtered', 'uncertain', 'ambiguous')), 0) / nullif(sum(n_dpm), 0), 6) AS resolved FROM (SELECT *, split_part(cluster, '_', 1)::BIGINT % 4 AS user_mod FROM clusters) GROUP BY user_mod"))
def resolved_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.resolved_share(_clusters(spark, sf_dir).withColumn("sample", F.split_part("cluster", F.lit("_"), F.lit(1)).cast("long") % 4), "sample")


# Distributions.


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clusters(spark, sf_dir).withColumn("size", F.col("n_dpm") + F.col("n_oligo"))


_BIN = "CASE WHEN size <= 0 THEN '0' WHEN size <= 1 THEN '1' WHEN size <= 5 THEN '2-5' WHEN size <= 10 THEN '6-10' WHEN size <= 20 THEN '11-20' WHEN size <= 50 THEN '21-50' WHEN size <= 100 THEN '51-100' WHEN size <= 200 THEN '101-200' ELSE '201+' END"
_SIZED = f"sized AS (SELECT *, n_dpm + n_oligo AS size FROM clusters), binned AS (SELECT *, {_BIN} AS bin FROM sized)"


@query(_cte("SELECT label, bin, count(*) AS n_clusters, sum(size)::BIGINT AS n_reads FROM binned GROUP BY ALL", _SIZED))
def size_binning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sized(spark, sf_dir).groupBy("label", stats.size_bin(F.col("size")).alias("bin")).agg(F.count("*").alias("n_clusters"), F.sum("size").alias("n_reads"))


@query(_cte("SELECT label, round(coalesce(sum(size) FILTER (bin = '1'), 0) / sum(size), 6) AS one, round(coalesce(sum(size) FILTER (bin = '2-5'), 0) / sum(size), 6) AS few, round(coalesce(sum(size) FILTER (bin = '6-10'), 0) / sum(size), 6) AS some FROM binned GROUP BY label", _SIZED))
def bin_proportion_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = stats.share_within(size_binning(spark, sf_dir), "label", "n_reads")
    wide = shares.groupBy("label").pivot("bin", ["1", "2-5", "6-10"]).agg(F.first("share")).na.fill(0.0)
    return wide.select("label", F.col("1").alias("one"), F.col("`2-5`").alias("few"), F.col("`6-10`").alias("some"))


@query(_cte("SELECT label, size, round(sum(w) OVER (PARTITION BY label ORDER BY size) / sum(w) OVER (PARTITION BY label), 6) AS ecdf FROM (SELECT label, size, sum(size) AS w FROM sized GROUP BY ALL)", _SIZED))
def weighted_ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.weighted_ecdf(_sized(spark, sf_dir).withColumn("weight", F.col("size")), "label", "size", "weight")


@query("SELECT coalesce((user_id % 4)::VARCHAR, 'all') AS sample, event_type, count(*) AS n FROM events GROUP BY GROUPING SETS ((user_id % 4, event_type), (event_type))")
def sample_all_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").select((F.col("user_id") % 4).alias("sample"), "event_type", F.lit(1).cast("long").alias("n"))
    return stats.with_all(rows, "sample", ["event_type"], "n")


@query(_cte("SELECT count(size) AS n, round(avg(size), 6) AS mean, round(stddev_samp(size), 6) AS std, min(size) AS least, round(quantile_cont(size, 0.25), 6) AS q1, round(quantile_cont(size, 0.5), 6) AS q2, round(quantile_cont(size, 0.75), 6) AS q3, max(size) AS most FROM sized", _SIZED))
def describe_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.describe(_sized(spark, sf_dir), "size")


@query(_cte("SELECT label, round(quantile_cont(size, 0.25), 6) AS q1, round(quantile_cont(size, 0.5), 6) AS q2, round(quantile_cont(size, 0.75), 6) AS q3 FROM sized GROUP BY label", _SIZED))
def label_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.quartiles(_sized(spark, sf_dir), "label", "size")


@query(_cte("SELECT label, molecule, n, round(n / sum(n) OVER (PARTITION BY molecule), 6) AS share FROM (SELECT label, unnest(['n_dpm', 'n_oligo']) AS molecule, unnest([sum(n_dpm), sum(n_oligo)])::BIGINT AS n FROM clusters GROUP BY label)"))
def label_proportion_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _clusters(spark, sf_dir).groupBy("label").agg(F.sum("n_dpm").alias("n_dpm"), F.sum("n_oligo").alias("n_oligo"))
    return stats.share_within(wide.unpivot("label", ["n_dpm", "n_oligo"], "molecule", "n"), "molecule", "n")


@query(_cte("SELECT floor(size / 3)::BIGINT AS x_bin, n_oligo::BIGINT AS y_bin, count(*) AS n FROM sized GROUP BY ALL", _SIZED))
def hist2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram_2d(_sized(spark, sf_dir), "size", 3, "n_oligo", 1)


@query(_cte("SELECT floor(size / 2)::BIGINT AS bin, sum(n_dpm)::BIGINT AS n FROM sized GROUP BY ALL", _SIZED))
def weighted_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(_sized(spark, sf_dir), 2, "size", F.col("n_dpm"))


@query("SELECT c_custkey, CASE WHEN length(w) = 2 THEN w[1:1] || '0' || w[2:2] ELSE w END AS well FROM (SELECT c_custkey, chr((65 + c_custkey % 8)::INT) || (1 + c_custkey % 12) AS w FROM customer)")
def well_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("Tag-"), F.chr(65 + F.col("c_custkey") % 8), (1 + F.col("c_custkey") % 12).cast("string"))
    return _table(spark, sf_dir, "customer").select("c_custkey", stats.well(name).alias("well"))


# De-duplication, from line items.

_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
_DEDUP = "dedup AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k, count(*) OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus) AS dc FROM lineitem)"


def _dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicate(_table(spark, sf_dir, "lineitem"), "l_returnflag&l_linestatus", ("l_orderkey",), _ORDER)


@query(f"WITH {_DEDUP} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, dc FROM dedup WHERE k = 1")
def dedup_and_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dedup(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "dc")


@query("SELECT l_partkey, l_suppkey, count(*) AS dc FROM lineitem GROUP BY ALL")
def dedup_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicate(_table(spark, sf_dir, "lineitem"), "l_partkey&l_suppkey", (), ("l_orderkey", *_ORDER)).select("l_partkey", "l_suppkey", "dc")


@query(f"WITH {_DEDUP} SELECT dc, count(*) AS n_reads FROM dedup WHERE k = 1 GROUP BY dc")
def dedup_multiplicity_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.multiplicity(_dedup(spark, sf_dir))


@query(f"WITH {_DEDUP} SELECT count(*) AS n_written, sum(dc)::BIGINT AS n_total, round(1 - count(*) / sum(dc), 6) AS rate FROM dedup WHERE k = 1")
def dedup_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplication(_dedup(spark, sf_dir))


@query(f"WITH {_DEDUP} SELECT l_linestatus, count(*) AS n_written, sum(dc)::BIGINT AS n_total, round(1 - count(*) / sum(dc), 6) AS rate FROM dedup WHERE k = 1 GROUP BY l_linestatus")
def duplication_prop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplication(_dedup(spark, sf_dir), "l_linestatus")


@query()
def library_complexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.library_complexity(dedup.duplication(_dedup(spark, sf_dir), "l_linestatus"))


@query("""WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i FROM lineitem),
 s(l_orderkey, i, supps, parts, kept) AS (SELECT l_orderkey, i, [l_suppkey], [l_partkey], true FROM r WHERE i = 1 UNION ALL
  SELECT l_orderkey, i, CASE WHEN dup THEN supps ELSE list_append(supps, l_suppkey) END, CASE WHEN dup THEN parts ELSE list_append(parts, l_partkey) END, NOT dup
  FROM (SELECT r.l_orderkey, r.i, supps, parts, l_suppkey, l_partkey, list_contains(supps, l_suppkey) OR list_contains(parts, l_partkey) AS dup FROM s JOIN r ON r.l_orderkey = s.l_orderkey AND r.i = s.i + 1)),
 k AS (SELECT r.* FROM r JOIN s USING (l_orderkey, i) WHERE kept),
 c AS (SELECT r.l_orderkey, coalesce(CASE WHEN a.i <= r.i THEN a.i END, CASE WHEN b.i <= r.i THEN b.i END) AS i FROM r LEFT JOIN k a ON a.l_orderkey = r.l_orderkey AND a.l_suppkey = r.l_suppkey LEFT JOIN k b ON b.l_orderkey = r.l_orderkey AND b.l_partkey = r.l_partkey)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, count(*) AS dc FROM c JOIN k USING (l_orderkey, i) GROUP BY ALL""")
def dedup_or_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", *_ORDER)
    # The two columns are alternatives of their own: equal numbers of both are no common key.
    marked = lines.withColumn("supp", F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).withColumn("part", F.concat(F.lit("p"), F.col("l_partkey").cast("string")))
    return dedup.deduplicate(marked, "supp|part", ("l_orderkey",), _ORDER).drop("supp", "part")


@query("SELECT o_custkey AS key, count(*) AS dc, min(o_orderkey) AS first FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey UNION ALL SELECT NULL, 1, o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def keep_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("key"), F.col("o_orderkey").alias("first"))
    return dedup.deduplicate(orders, "key", (), ("first",)).select("key", "dc", "first")


# Barcodes.


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as named reads: three tags, the last not found where l_linenumber is 7."""
    kind = F.when(F.col("l_returnflag") == "N", F.concat(F.lit("BEAD_"), "l_linestatus")).otherwise(F.concat(F.lit("DPM"), "l_returnflag"))
    tags = F.array(kind, F.concat(F.lit("Y"), (F.col("l_suppkey") % 10).cast("string")), F.when(F.col("l_linenumber") == 7, "NOT_FOUND").otherwise(F.concat(F.lit("E"), (F.col("l_partkey") % 20).cast("string"))))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", barcode.named(F.concat(F.lit("r"), F.col("l_orderkey").cast("string"), F.lit(" x")), tags).alias("qname"))


_NAMED = """named AS (SELECT l_orderkey, l_linenumber, 'r' || l_orderkey || '::[' || CASE WHEN l_returnflag = 'N' THEN 'BEAD_' || l_linestatus ELSE 'DPM' || l_returnflag END || '][Y' || (l_suppkey % 10) || '][' ||
 CASE WHEN l_linenumber = 7 THEN 'NOT_FOUND' ELSE 'E' || (l_partkey % 20) END || ']' AS qname FROM lineitem),
tagged AS (SELECT *, regexp_extract_all(qname, '\\[([a-zA-Z0-9_-]+)\\]', 1) AS tags FROM named)"""


@query(f"WITH {_NAMED} SELECT l_orderkey, l_linenumber, qname, tags[1] AS RT, array_to_string(tags[2:], '.') || '.s1' AS CB FROM tagged")
def barcode_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcode.barcode_to_tags(_named(spark, sf_dir), 3, sample="s1", clean=False).select("l_orderkey", "l_linenumber", "qname", "RT", "CB")


_ROUNDS = {f"Y{k}": [1] for k in range(9)} | {f"E{k}": [2] for k in range(18)} | {"E18": [1]}


@query(f"""WITH {_NAMED} SELECT CASE WHEN list_contains(tags, 'NOT_FOUND') THEN 'short' WHEN tags[2] = 'Y9' OR tags[3] IN ('E18', 'E19') THEN 'other' WHEN contains(qname, 'DPM') THEN 'dpm' ELSE 'bpm' END AS route, count(*) AS n FROM tagged GROUP BY 1""")
def barcode_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcode.route(_named(spark, sf_dir), _ROUNDS).groupBy("route").agg(F.count("*").alias("n"))


@query(f"WITH {_NAMED} SELECT len(list_filter(tags, lambda t: t <> 'NOT_FOUND'))::INT AS n_found, count(*) AS n_reads, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM tagged GROUP BY 1")
def barcode_efficiency_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcode.tags_found(_named(spark, sf_dir))


@query(f"WITH {_NAMED} SELECT position, count(*) AS n_reads FROM (SELECT unnest([0, 1, 2])::INT AS position, unnest(tags) AS tag FROM tagged) WHERE tag <> 'NOT_FOUND' GROUP BY position")
def barcode_efficiency_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcode.positions_found(_named(spark, sf_dir))


_DNA = "translate(md5({}), '0123456789abcdef', 'ACGTACGTACGTACGT')"


@query(f"WITH d AS (SELECT c_custkey, {_DNA.format('c_name')} AS s FROM customer) SELECT c_custkey, s[1:8] AS RX, s[9:] AS seq, 'BEAD_A' AS RT, 'Y1.E2' AS CB, 4 AS flag FROM d")
def umi_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("@r"), F.col("c_custkey").cast("string"), F.lit("::[BEAD_A][Y1][E2]")).alias("qname"), pseudo_dna(F.col("c_name")).alias("seq"))
    return barcode.oligo_records(reads.withColumn("qual", F.col("seq")), 3, 8).select("c_custkey", "RX", "seq", "RT", "CB", "flag")


def _tags(spark: SparkSession, sf_dir: str, length: int) -> list[tuple[str, str, str, int]]:
    """A tag for each nation: a tag list is settings, read on the driver from a table of fixed size."""
    rows = _table(spark, sf_dir, "nation").select("n_nationkey", F.substring(pseudo_dna(F.col("n_name")), 1, length).alias("seq")).orderBy("n_nationkey").collect()
    return [("Y", f"Y{r['n_nationkey']}", r["seq"], 1) for r in rows]


@query(f"""SELECT c_custkey, max_by('Y' || n_nationkey, n_nationkey) AS tag FROM (SELECT c_custkey, {_DNA.format('c_name')}[1:6] AS a FROM customer) c JOIN (SELECT n_nationkey, {_DNA.format('n_name')}[1:6] AS b FROM nation) s ON hamming(a, b) <= 1 GROUP BY c_custkey""")
def hamming_tag_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = barcode.expand_tags(spark, _tags(spark, sf_dir, 6))
    reads = _table(spark, sf_dir, "customer").select("c_custkey", F.substring(pseudo_dna(F.col("c_name")), 1, 6).alias("seq"))
    return reads.join(book, "seq").select("c_custkey", F.col("name").alias("tag"))


@query(f"WITH t AS (SELECT s_suppkey AS k, {_DNA.format('s_name')}[1:8] AS s FROM supplier) SELECT a.k AS one, b.k AS two, hamming(a.s, b.s) AS apart FROM t a JOIN t b ON a.k < b.k AND hamming(a.s, b.s) <= 2")
def hamming_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcode.close_tags(_table(spark, sf_dir, "supplier").select("s_suppkey", F.substring(pseudo_dna(F.col("s_name")), 1, 8).alias("seq")), 2, "s_suppkey")


@query(f"""WITH t AS (SELECT n_nationkey, {_DNA.format('n_name')}[1:5] AS s FROM nation), c AS (SELECT c_custkey, {_DNA.format('c_name')} AS d FROM customer),
 h AS (SELECT c_custkey, o, max(n_nationkey) AS k FROM c, (SELECT unnest(range(7)) AS o), t WHERE hamming(d[10 + o:14 + o], s) <= 1 GROUP BY ALL)
 SELECT c.c_custkey, coalesce('Y' || min_by(k, o), 'NOT_FOUND') AS tag FROM c LEFT JOIN h USING (c_custkey) GROUP BY c.c_custkey""")
def barcode_scan_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _table(spark, sf_dir, "customer").select("c_custkey", F.lit("A").alias("seq1"), F.concat(F.lit("GGG"), F.substring(pseudo_dna(F.col("c_name")), 4, 32)).alias("seq2"))
    tags = [("DPM", "D", "GGGGGG", 0), *_tags(spark, sf_dir, 5)]
    # A first category that fits nowhere moves on by its six bases and the laxity of 0, and the spacer by three more.
    found = barcode.identify(reads, {"READ2": ["DPM", "SPACER", "Y"]}, tags, spacer=3, laxity=6)
    return found.select("c_custkey", F.element_at("tags", -1).alias("tag"))


@query(f"WITH {_NAMED}, n AS (SELECT len(list_filter(tags, lambda t: t <> 'NOT_FOUND'))::INT AS k, count(*) AS n FROM tagged GROUP BY 1) SELECT i::INT AS line_no, coalesce(n, 0) || ' (' || printf('%.1f', 100 * coalesce(n, 0) / (SELECT sum(n) FROM n)) || '%) reads found with ' || i || ' tags' AS line FROM range(4) r(i) LEFT JOIN n ON k = i")
def efficiency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barcode.efficiency_report(barcode.tags_found(_named(spark, sf_dir)), 3)


@query(f"SELECT s AS seq, count(*) AS n_names FROM (SELECT {_DNA.format('s_name')}[1:3] AS s FROM supplier) GROUP BY s HAVING count(*) > 1")
def ambiguous_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = _table(spark, sf_dir, "supplier").select(F.lit("Y").alias("category"), F.col("s_name").alias("name"), F.substring(pseudo_dna(F.col("s_name")), 1, 3).alias("seq"), F.lit(0).alias("mismatches"), F.col("s_suppkey").alias("place"))
    return barcode.ambiguous(tags).drop("category")


# Chromosomes and intervals.


def _kept_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name table that keeps the nations of two regions."""
    nation = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region").where("r_name IN ('ASIA', 'EUROPE')"), F.col("n_regionkey") == F.col("r_regionkey"))
    return nation.select(F.col("n_nationkey").cast("string").alias("old"), F.col("n_name").alias("new"), F.col("n_nationkey").alias("sort_order"))


@query("SELECT s_suppkey, n_name AS rname, n_nationkey AS sort_order FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')")
def chrom_rename_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _kept_names(spark, sf_dir)
    records = _table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("rname"))
    return chrom.rename_chromosomes(records, names)


@query("SELECT n_name AS chrom, n_nationkey * 10 AS length FROM nation JOIN region ON n_regionkey = r_regionkey")
def chrom_sizes_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    names = nation.join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").cast("string").alias("old"), F.col("n_name").alias("new"), F.col("n_nationkey").alias("sort_order"))
    return chrom.join_sizes(names, nation.select(F.col("n_nationkey").cast("string").alias("chrom"), (F.col("n_nationkey") * 10).alias("length")))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= 20 AND l_linenumber & 4 = 0")
def mapq_flag_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_quantity": "mapq", "l_linenumber": "flag"})
    return chrom.mapped_primary(records).select("l_orderkey", F.col("flag").alias("l_linenumber"), "l_partkey", F.col("mapq").alias("l_quantity"))


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = day_number(F.col("o_orderdate")).cast("long")
    return intervals.merge_intervals(_table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 450000).select(F.col("o_orderstatus").alias("chrom"), day.alias("start"), (day + 3).alias("end")))


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = day_number(F.col("l_shipdate")).cast("long")
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linestatus").alias("chrom"), F.col("l_returnflag").alias("target"), day.alias("start"), (day + F.col("l_quantity").cast("long")).alias("end"))


_SPANS = "spans AS (SELECT l_orderkey, l_linenumber, l_linestatus AS chrom, l_returnflag AS target, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) AS s, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) + l_quantity::BIGINT AS e FROM lineitem)"
_MASK = """raw AS (SELECT o_orderstatus AS chrom, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS s FROM orders WHERE o_totalprice > 450000),
 marked AS (SELECT chrom, s, s + 3 AS e, s > max(s + 3) OVER (PARTITION BY chrom ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fresh FROM raw),
 islands AS (SELECT *, sum(coalesce(fresh, false)::INT) OVER (PARTITION BY chrom ORDER BY s ROWS UNBOUNDED PRECEDING) AS island FROM marked),
 mask AS (SELECT chrom, min(s) AS s, max(e) AS e FROM islands GROUP BY chrom, island)"""


@query(f'WITH {_MASK} SELECT chrom, s AS "start", e AS "end" FROM mask')
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mask(spark, sf_dir)


@query(f'WITH {_MASK}, {_SPANS} SELECT l_orderkey, l_linenumber, chrom, s AS "start", e AS "end" FROM spans r WHERE NOT EXISTS (SELECT 1 FROM mask m WHERE m.chrom = r.chrom AND r.s < m.e AND m.s < r.e)')
def mask_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.mask(_spans(spark, sf_dir), _mask(spark, sf_dir)).drop("target")


@query(f'WITH {_MASK}, {_SPANS} SELECT l_orderkey, l_linenumber, chrom, s AS "start", e AS "end" FROM spans r WHERE EXISTS (SELECT 1 FROM mask m WHERE m.chrom = r.chrom AND r.s < m.e AND m.s < r.e)')
def mask_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.mask(_spans(spark, sf_dir), _mask(spark, sf_dir), "inside").drop("target")


_COVER = f"{_SPANS}, cover AS (SELECT target, chrom, unnest(range(s // 30, (e - 1) // 30 + 1)) AS bin FROM spans WHERE s < e), bins AS (SELECT target, chrom, bin, count(*) AS n FROM cover GROUP BY ALL), total AS (SELECT target, count(*) AS reads FROM spans GROUP BY target)"


def _cover(spark: SparkSession, sf_dir: str, how: str | None) -> DataFrame:
    return intervals.coverage(_spans(spark, sf_dir), 30, ("target",), how, effective_size=100_000, fragment_length=25).withColumn("value", F.round("value", 6))


@query(f"WITH {_COVER} SELECT target, chrom, bin, n, n::DOUBLE AS value FROM bins")
def binned_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cover(spark, sf_dir, None)


@query(f"WITH {_COVER} SELECT target, chrom, bin, n, round(n * 1e6 / reads, 6) AS value FROM bins JOIN total USING (target)")
def coverage_cpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cover(spark, sf_dir, "CPM")


@query(f"WITH {_COVER} SELECT target, chrom, bin, n, round(n * 1e6 / reads / (30 / 1000), 6) AS value FROM bins JOIN total USING (target)")
def coverage_rpkm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cover(spark, sf_dir, "RPKM")


@query(f"WITH {_COVER} SELECT target, chrom, bin, n, round(n * 1e6 / sum(n) OVER (PARTITION BY target), 6) AS value FROM bins")
def coverage_bpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cover(spark, sf_dir, "BPM")


@query(f"WITH {_COVER} SELECT target, chrom, bin, n, round(n / (reads * 25.0::DOUBLE / 100000.0::DOUBLE), 6) AS value FROM bins JOIN total USING (target)")
def coverage_rpgc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cover(spark, sf_dir, "RPGC")


@query(f"WITH {_SPANS} SELECT o_orderstatus AS chrom, coalesce(bin, 0) AS bin, coalesce(n, 0) AS n, coalesce(n, 0)::DOUBLE AS value FROM (SELECT DISTINCT o_orderstatus FROM orders) LEFT JOIN (SELECT chrom, bin, count(*) AS n FROM (SELECT chrom, unnest(range(s // 30, (e - 1) // 30 + 1)) AS bin FROM spans WHERE s < e) GROUP BY ALL) ON o_orderstatus = chrom")
def zero_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.with_empty(intervals.coverage(_spans(spark, sf_dir), 30), _table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("chrom")))


@query("SELECT sum(length(text) - length(translate(text, 'ACGT', '')))::BIGINT AS n_bases FROM documents")
def unmasked_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.unmasked_bases(_table(spark, sf_dir, "documents"), "text")


# Co-occurrence, from the brands of a customer's orders.


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.groupBy(F.col("o_custkey").alias("cluster"), F.col("p_brand").alias("target")).agg(F.count("*").alias("n"))


_BRANDS = """counts AS (SELECT o_custkey AS cluster, p_brand AS target, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL),
 passing AS (SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY cluster) AS total FROM counts) WHERE n >= 2 AND n >= 0.05 * total), sized AS (SELECT *, count(*) OVER (PARTITION BY cluster) AS k FROM passing),
 upper_ AS (SELECT a.target AS target_i, b.target AS target_j, count(*)::DOUBLE AS value, round(sum(2.0::DOUBLE / a.k), 6) AS over_two FROM sized a JOIN sized b ON a.cluster = b.cluster AND a.target <= b.target GROUP BY ALL),
 both_ AS (SELECT target_i, target_j, value FROM upper_ UNION ALL SELECT target_j, target_i, value FROM upper_ WHERE target_i <> target_j)"""


def _matrix(spark: SparkSession, sf_dir: str, weight: str = "none") -> DataFrame:
    return interactions.interaction_matrix(_brands(spark, sf_dir), 2, 0.05, weight)


@query(f"WITH {_BRANDS} SELECT target_i, target_j, value FROM upper_")
def interaction_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix(spark, sf_dir)


@query(f"WITH {_BRANDS} SELECT target_i, target_j, over_two AS value FROM upper_")
def interaction_n_over_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matrix(spark, sf_dir, "n_over_two").withColumn("value", F.round("value", 6))


@query(f"WITH {_BRANDS} SELECT b.target_i, b.target_j, round(b.value / d.value, 6) AS value FROM both_ b LEFT JOIN both_ d ON b.target_i = d.target_i AND d.target_i = d.target_j")
def interaction_norm_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.normalize_by_clusters(interactions.full_matrix(_matrix(spark, sf_dir))).withColumn("value", F.round("value", 6))


@query(f"WITH {_BRANDS} SELECT target_i, target_j, round(coalesce(v / nullif(sum(v) OVER (PARTITION BY target_i), 0), 0), 6) AS value FROM (SELECT *, CASE WHEN target_i = target_j THEN 0 ELSE value END AS v FROM both_)")
def interaction_norm_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.normalize_by_pairwise(interactions.full_matrix(_matrix(spark, sf_dir))).withColumn("value", F.round("value", 6))


@query(f"WITH {_BRANDS} SELECT target_i, target_j, round(log10(value + min(value) FILTER (value > 0) OVER () / 10), 6) AS value FROM both_")
def interaction_log10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.log_matrix(interactions.full_matrix(_matrix(spark, sf_dir))).withColumn("value", F.round("value", 6))


@query(_cte("SELECT cluster, coalesce(sum(n) FILTER (target = 'error'), 0)::BIGINT AS error, coalesce(sum(n) FILTER (target = 'purchase'), 0)::BIGINT AS purchase FROM counts WHERE target IN ('error', 'purchase') GROUP BY cluster"))
def target_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.to_dense(clusters.target_counts(_reads(spark, sf_dir)), ["error", "purchase"])


# Funnels, chunks, checks.

_LEVELS = [("data", None, None), ("large", "data", "data"), ("returned", "large", "data"), ("late", "returned", "large")]


@query("""WITH c AS (SELECT l_linestatus AS sample, count(*) AS data, count(*) FILTER (l_quantity >= 10) AS large, count(*) FILTER (l_quantity >= 10 AND l_returnflag = 'R') AS returned,
 count(*) FILTER (l_quantity >= 10 AND l_returnflag = 'R' AND l_tax > 0.04) AS late FROM lineitem GROUP BY 1)
SELECT sample, 'data' AS level, 0 AS depth, data AS n, NULL::DOUBLE AS frac_parent, NULL::DOUBLE AS frac_base, NULL::DOUBLE AS frac_root FROM c
UNION ALL SELECT sample, 'large', 1, large, round(large / nullif(data, 0), 6), round(large / nullif(data, 0), 6), round(large / nullif(data, 0), 6) FROM c
UNION ALL SELECT sample, 'returned', 2, returned, round(returned / nullif(large, 0), 6), round(returned / nullif(data, 0), 6), round(returned / nullif(data, 0), 6) FROM c
UNION ALL SELECT sample, 'late', 3, late, round(late / nullif(returned, 0), 6), round(late / nullif(large, 0), 6), round(late / nullif(data, 0), 6) FROM c""")
def funnel_fracs(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = F.col("l_quantity") >= 10
    returned = large & (F.col("l_returnflag") == "R")
    late = returned & (F.col("l_tax") > 0.04)
    counts = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_linestatus").alias("sample")).agg(F.count("*").alias("data"), F.count_if(large).alias("large"), F.count_if(returned).alias("returned"), F.count_if(late).alias("late"))
    return funnel.funnel(counts.unpivot("sample", ["data", "large", "returned", "late"], "level", "n"), _LEVELS)


@query("SELECT o_orderkey, CASE WHEN (SELECT ceil(count(*) / ceil(count(*) / 7)) FROM orders) = 7 THEN i // (SELECT ceil(count(*) / 7)::BIGINT FROM orders) ELSE least(6, i // (SELECT count(*) // 7 FROM orders)) END AS chunk FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)")
def chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are numbered in ranges of keys: each range's rows by a window, ranges by their counts."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey").withColumn("part", F.expr("o_orderkey div 10000"))
    sizes = orders.groupBy("part").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    at = F.row_number().over(Window.partitionBy("part").orderBy("o_orderkey")) - 1
    indexed = orders.withColumn("at", at).join(sizes.select("part", "base"), "part").select("o_orderkey", (F.col("base") + F.col("at")).alias("idx"))
    return funnel.chunks(indexed, 7, count=orders.count()).select("o_orderkey", F.col("chunk").cast("long").alias("chunk"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def validate_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.missing_keys(_table(spark, sf_dir, "customer"), _table(spark, sf_dir, "orders"), "c_custkey", "o_custkey")


@query("SELECT p_brand, min(p_partkey) AS first FROM part GROUP BY p_brand")
def distinct_ordered_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.first_seen(_table(spark, sf_dir, "part"), "p_brand", "p_partkey")


@query("SELECT p_brand, p_size, p_partkey, p_retailprice FROM part")
def coordinate_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select("p_brand", "p_size", "p_partkey", "p_retailprice").orderBy("p_brand", "p_size", "p_partkey")


# Positions, counters, orders, dimensions.


@query("SELECT l_linestatus AS rname, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) AS \"start\", date_diff('day', DATE '1970-01-01', l_shipdate::DATE) + l_quantity::BIGINT AS \"end\", l_returnflag, count(*) AS dc FROM lineitem GROUP BY ALL")
def dedup_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _spans(spark, sf_dir).withColumnsRenamed({"chrom": "rname", "target": "l_returnflag"})
    return dedup.deduplicate(reads, "start&end", ("l_returnflag",), ("l_orderkey", "l_linenumber")).select("rname", "start", "end", "l_returnflag", "dc")


@query("SELECT n_name AS chrom, c_custkey, n_nationkey AS sort_order FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')")
def fasta_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("chrom"))
    return chrom.rename_fasta(records, _kept_names(spark, sf_dir)).select("chrom", "c_custkey", "sort_order")


@query("SELECT count(*) AS n_index, sum(length)::BIGINT AS bases_index, count(*) FILTER (kept) AS n_kept, coalesce(sum(length) FILTER (kept), 0)::BIGINT AS bases_kept FROM (SELECT s_suppkey AS length, r_name IN ('ASIA', 'EUROPE') AS kept FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)")
def genome_size_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("chrom"), F.col("s_suppkey").alias("length"))
    return chrom.size_totals(index, _kept_names(spark, sf_dir))


@query("SELECT o_orderstatus AS chrom, count(*) AS n, o_orderstatus IN (SELECT l_linestatus FROM lineitem) AS known FROM orders GROUP BY 1")
def mask_chromosomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chrom.mask_chromosomes(_table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("chrom")), _table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("chrom")))


@query("SELECT p_brand, row_number() OVER (ORDER BY regexp_extract(p_brand, '^(\\D*)', 1), regexp_extract(p_brand, '^\\D*(\\d+)', 1)::BIGINT) AS place FROM (SELECT DISTINCT p_brand FROM part)")
def version_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _table(spark, sf_dir, "part").select("p_brand").distinct()
    return names.withColumn("place", F.row_number().over(Window.orderBy(*chrom.version_order(F.col("p_brand")))).cast("long"))


@query("SELECT count(*) AS n_read, count(*) FILTER (l_quantity < 20) AS n_low, count(*) FILTER (l_quantity >= 20 AND l_returnflag = 'R') AS n_returned, count(*) FILTER (l_quantity >= 20 AND l_returnflag <> 'R') AS n_written FROM lineitem")
def read_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.counters(_table(spark, sf_dir, "lineitem"), {"low": F.col("l_quantity") < 20, "returned": F.col("l_returnflag") == "R"})


@query("SELECT event_type, count(*) AS n, CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS rank FROM events GROUP BY event_type")
def rank_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return stats.ranked(counts, "event_type", ["purchase", "click"]).orderBy("rank", "event_type")


@query("SELECT user_id % 4 AS sample, round(count(*) FILTER (event_type = 'click') / count(*), 6) AS efficiency FROM events GROUP BY 1")
def overall_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _table(spark, sf_dir, "events").select((F.col("user_id") % 4).alias("sample"), "event_type")
    counted = lambda df: df.groupBy("sample").agg(F.count("*").alias("n"))
    return stats.ratio(counted(reads.where("event_type = 'click'")), counted(reads), ("sample",))


@query("SELECT sample, event_type FROM (SELECT DISTINCT user_id % 4 AS sample FROM events), (SELECT DISTINCT event_type FROM events)")
def dimension_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return stats.product(events.select((F.col("user_id") % 4).alias("sample")), events.select("event_type"))


@query("SELECT DISTINCT p_brand AS label FROM part UNION SELECT unnest(['none', 'filtered', 'uncertain', 'ambiguous'])")
def label_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.read_groups(_table(spark, sf_dir, "part").select(F.col("p_brand").alias("target")), "s").select(F.col("id").alias("label"))


@query("SELECT coalesce('s' || (CASE WHEN user_id % 5 < 4 THEN user_id % 5 END), 'all') AS sample, event_type AS target, event_id AS n FROM events")
def path_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = F.when(F.col("user_id") % 5 < 4, F.concat(F.lit("s"), (F.col("user_id") % 5).cast("string"), F.lit(".labelled/"))).otherwise("")
    return stats.path_counts(_table(spark, sf_dir, "events").select(F.concat(folder, "event_type", F.lit(".bam")).alias("path"), "event_id"), "path", "event_id")


@query("""SELECT p_partkey, replace(p_brand, '#', '_') AS replaced, (length(p_name) - length(replace(p_name, 'a', '')))::INT AS occurrences, lpad(p_size::VARCHAR, 4, '0') AS padded,
 regexp_extract(p_brand, '#(\\d)(\\d)', 1) AS one, regexp_extract(p_brand, '#(\\d)(\\d)', 2) AS two, greatest(p_size / 100, 0.1)::DOUBLE AS floored FROM part""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.col("p_brand")
    return _table(spark, sf_dir, "part").select(
        "p_partkey",
        F.replace(brand, F.lit("#"), F.lit("_")).alias("replaced"),
        F.regexp_count("p_name", F.lit("a")).alias("occurrences"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
        F.regexp_extract(brand, r"#(\d)(\d)", 1).alias("one"),
        F.regexp_extract(brand, r"#(\d)(\d)", 2).alias("two"),
        F.greatest(F.nanvl(F.col("p_size") / 100, F.lit(0.0)), F.lit(0.1)).alias("floored"),
    )


# Files, written to the shared folder and read again.


@query("SELECT 'r' || l_orderkey || '.' || l_linenumber AS qname, l_linenumber::INT AS flag, l_returnflag AS rname, l_suppkey::BIGINT AS pos, l_quantity::INT AS mapq, l_suppkey::BIGINT - 1 AS ref_start, l_suppkey::BIGINT + 1 + l_linenumber AS ref_end, l_partkey::VARCHAR AS nm, 'iZ' AS kinds, l_linestatus AS rt FROM lineitem")
def sam_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    star, none = F.lit("*"), F.lit(0).cast("long")
    records = _table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string")).alias("qname"),
        F.col("l_linenumber").cast("int").alias("flag"), F.col("l_returnflag").alias("rname"), F.col("l_suppkey").cast("long").alias("pos"), F.col("l_quantity").cast("int").alias("mapq"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("M2D3S")).alias("cigar"), star.alias("rnext"), none.alias("pnext"), none.alias("tlen"), star.alias("seq"), star.alias("qual"),
        F.create_map(F.lit("NM"), F.col("l_partkey").cast("string"), F.lit("RT"), "l_linestatus").alias("tags"), F.create_map(F.lit("NM"), F.lit("i"), F.lit("RT"), F.lit("Z")).alias("types"),
    )
    path = folder.fresh(spark, "sam")
    text.write_sam(records, ["@HD\tVN:1.6", "@SQ\tSN:R\tLN:1000"], path)
    back = text.read_sam(spark, path)
    kinds = F.concat(F.element_at("types", "NM"), F.element_at("types", "RT"))
    return back.select("qname", "flag", "rname", "pos", "mapq", "ref_start", "ref_end", F.element_at("tags", "NM").alias("nm"), kinds.alias("kinds"), F.element_at("tags", "RT").alias("rt"))


@query(f'WITH {_SPANS} SELECT chrom, s AS "start", e AS "end", count(*) AS n FROM spans GROUP BY ALL')
def bed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder.fresh(spark, "bed")
    text.write_bed(_spans(spark, sf_dir), path)
    return text.read_bed(spark, path).groupBy("chrom", "start", "end").agg(F.count("*").alias("n"))


@query(f"SELECT c_custkey::VARCHAR AS chrom, {_DNA.format('c_name')} AS seq FROM customer")
def fasta_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder.fresh(spark, "fasta")
    text.write_fasta(_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("chrom"), pseudo_dna(F.col("c_name")).alias("seq")), path, 10)
    return text.read_fasta(spark, path)


@query("SELECT count(*) AS n_reads FROM customer")
def fastq_read_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder.fresh(spark, "fastq")
    dna = pseudo_dna(F.col("c_name"))
    text.write_fastq(_table(spark, sf_dir, "customer").select(F.col("c_name").alias("qname"), dna.alias("seq"), F.repeat(F.lit("I"), F.length(dna)).alias("qual")), path)
    return text.fastq_reads(spark, path)


@query(f"WITH {_COVER} SELECT chrom, bin * 30 AS \"start\", (bin + 1) * 30 AS \"end\", sum(n)::DOUBLE AS value FROM bins GROUP BY chrom, bin")
def bedgraph_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder.fresh(spark, "bedgraph")
    text.write_bedgraph(intervals.coverage(_spans(spark, sf_dir), 30), 30, path)
    return spark.read.csv(path, sep="\t", schema="chrom string, start long, end long, value double")


@query(_cte("SELECT cluster, n_dpm, n_oligo, label FROM clusters"))
def cluster_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder.fresh(spark, "summaries")
    clusters.write_summaries(_clusters(spark, sf_dir).select("cluster", "n_dpm", "n_oligo", "label"), path)
    return spark.read.csv(f"{path}/clusters", header=True, schema="cluster string, n_dpm long, n_oligo long, label string")
