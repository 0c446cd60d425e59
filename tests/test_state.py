"""Labels over batches, counters within a write, closures, targets over files, intervals across spans, bigWig files."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from brindle import streaming
from brindle.operators import barcode, clusters, funnel, intervals, stats
from brindle.sources import bigwig, ranges, text


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_labels_follow_batches_and_replays(spark, tmp_path):
    rng = random.Random(0)
    batches = [[(f"c{rng.randrange(6)}", rng.choice(["DPM1", "BEAD_A", "BEAD_A", "BEAD_B", "RPM", None])) for _ in range(25)] for _ in range(3)]
    made = lambda reads: spark.createDataFrame(reads, "cluster string, read_type string")
    labels = streaming.ClusterLabels(spark, str(tmp_path / "state"), 2, 0.5, 100)

    def check(upto):
        whole = clusters.summarize_clusters(made([r for b in batches[:upto] for r in b]), 2, 0.5, 100)
        assert rows(labels.labels(), *whole.columns) == rows(whole)

    for k, batch in enumerate(batches):
        labels.merge(made(batch), k)
        check(k + 1)
        if k:
            labels.merge(made(batch), k)  # the same batch once more
            check(k + 1)
        if k == 1:
            labels.compact(1)
            check(2)


def test_counters_come_from_the_job_that_writes(spark, tmp_path):
    reads = spark.createDataFrame([(n, "AC", "II") for n in ["a::[DPM1][Y1]", "b::[BEAD_A][NOT_FOUND]", "c", "d::[RPM][Y1]", "e::[BEAD_A][Y1]"]], "qname string, seq string, qual string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("write", "one write")
    found = text.write_routed(reads, str(tmp_path / "w"), barcode.barcode_faults(2), compression="none")
    jobs = tracker.getJobIdsForGroup("write")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == {"n_read": 5, "n_no_barcode": 1, "n_other_type": 1, "n_written": 3} and len(jobs) == 1
    assert found == stats.counters(reads, barcode.barcode_faults(2)).first().asDict()
    routed = {route: [r["qname"] for r in ranges.read_fastq(spark, str(tmp_path / "w" / f"route={route}")).collect()] for route in ("dpm", "bpm", "short")}
    assert routed == {"dpm": ["a::[DPM1][Y1]"], "bpm": ["e::[BEAD_A][Y1]"], "short": ["b::[BEAD_A][NOT_FOUND]"]}


def test_closure(spark):
    chain = [(k, k - 1 if k else None) for k in range(40)] + [(100, 999), (101, 100), (102, 100)]
    got = rows(funnel.closure(spark.createDataFrame(chain, "level long, parent long")))
    assert got == [(k, 0, k) for k in range(40)] + [(100, 100, 0), (101, 100, 1), (102, 100, 1)]
    levels = [("a", None, None), ("b", "a", "a"), ("c", "b", "a")]
    own = funnel.closure(spark.createDataFrame([(a, b) for a, b, _ in levels], "level string, parent string"))
    assert rows(own) == sorted((level, root, depth) for level, _, _, root, depth in funnel.depths(levels))
    with pytest.raises(ValueError, match="ancestor"):
        funnel.closure(spark.createDataFrame([(1, 2), (2, 1)], "level long, parent long"))


def test_large_target_is_written_by_several_tasks(spark, tmp_path):
    records = spark.range(20_000).select(F.lit("s").alias("sample"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("t"), (F.col("id") % 70).cast("string"))).otherwise("hot").alias("target"), (F.col("id") % 3).alias("sort_order"), ((F.col("id") * 7919) % 10_007).alias("ref_start"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data would be one range
    try:
        text.write_by_target(records, str(tmp_path / "t"), tie=("id",))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = text.read_target(spark, str(tmp_path / "t"), target="hot").select("*", F.col("_metadata.file_name").alias("file"))
    files = sorted(r["file"] for r in found.select("file").distinct().collect())
    assert len(files) >= 3
    one = [tuple(r) for f in files for r in spark.read.parquet(f"{tmp_path}/t/sample=s/target=hot/{f}").select("sort_order", "ref_start", "id").collect()]
    assert one == sorted(one) and len(one) == 18_000
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000


@pytest.mark.parametrize("gap", [0, 3])
def test_merge_is_brute_force_over_spans(spark, gap):
    rng = random.Random(gap)
    made = [(rng.choice("ab"), s, s + rng.choice([0, 1, 5, 40, 500 if rng.random() < 0.1 else 2])) for s in (rng.randrange(-50, 2000) for _ in range(400))]
    want = []
    for chrom in "ab":
        for s, e in sorted((s, e) for c, s, e in made if c == chrom):
            if want and want[-1][0] == chrom and s <= want[-1][2] + gap:
                want[-1][2] = max(want[-1][2], e)
            else:
                want.append([chrom, s, e])
    df = spark.createDataFrame(made, "chrom string, start long, end long")
    for span in (7, 100, 1_000_000):
        assert rows(intervals.merge_intervals(df, gap, span), "chrom", "start", "end") == sorted(map(tuple, want))


def test_bigwig(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bigwig, "NODE", 2)  # so that the index has several levels
    rng = random.Random(5)
    made, sizes = [], [("chr1", 200_000), ("chr10", 90_000), ("chr2", 50_000), ("empty", 777)]
    for chrom, size in sizes[:3]:
        at = 0
        while at < size - 100 and len(made) < 9_000:
            at += rng.randrange(1, 30)
            end = at + rng.randrange(1, 50)
            made.append((chrom, at, end, float(rng.randrange(-5, 100))))
            at = end
    path = str(tmp_path / "x.bw")
    frame = spark.createDataFrame(made, "chrom string, start long, end long, value double")
    bigwig.write_bigwig(frame, spark.createDataFrame(sizes, "chrom string, length long"), path, 10)
    every = sorted([*made, ("empty", 0, 777, 0.0)])
    assert rows(bigwig.read_bigwig(spark, path)) == every
    inside = ("chr1", 5_000, 9_000)
    assert rows(bigwig.read_bigwig(spark, path, within=inside)) == [r for r in every if r[0] == "chr1" and r[1] < 9_000 and r[2] > 5_000]
    assert bigwig.read_bigwig(spark, path, within=("none", 0, 9)).count() == 0
    head = bigwig.BigWig(path)
    assert dict(head.chroms.values()) == dict(sizes) and len(head.blocks(path)) > len(head.blocks(path, 0, 0, 5_000, 9_000)) > 0
    covered, least, most, total, squares = head.summary
    assert (covered, least, most) == (sum(e - s for _, s, e, _ in every), min(r[3] for r in every), 99.0) and total == sum((e - s) * v for _, s, e, v in every)
    for width in list(head.indexes)[1:]:
        zoom = bigwig.read_bigwig(spark, path, zoom=width)
        assert zoom.agg(F.sum("valid")).first()[0] == covered and abs(zoom.agg(F.sum("sum")).first()[0] - total) < 1e-3 * abs(total)
        assert zoom.where(F.expr(f"start div {width} <> (end - 1) div {width}")).count() == 0
    data = open(path, "rb").read()
    assert struct.unpack("<I", data[-4:])[0] == bigwig.MAGIC == struct.unpack("<I", data[:4])[0]
    with pytest.raises(Exception, match="no such chromosome"):
        bigwig.write_bigwig(frame.limit(5).withColumn("chrom", F.lit("chrX")), spark.createDataFrame(sizes, "chrom string, length long"), path)
