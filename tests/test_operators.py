import gzip
import random

import pytest

from brindle.operators import barcode, chrom, clusters, dedup, funnel, interactions, intervals
from brindle.sources import settings, text


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


@pytest.mark.parametrize(
    "dpm, oligos, label",
    [(3, "", "none"), (9, "", "none"), (4, "AA", "filtered"), (1, "A", "uncertain"), (1, "AAB", "ambiguous"), (1, "AAAAB", "A")],
)
def test_label_ladder(spark, dpm, oligos, label):
    reads = [("c", "DPM1")] * dpm + [("c", f"BEAD_{o}") for o in oligos] + [("c", "RPM")]
    got = clusters.summarize_clusters(spark.createDataFrame(reads, "cluster string, read_type string"), 2, 0.8, 3).first()
    assert (got["label"], got["n_dpm"], got["n_oligo"]) == (label, dpm, len(oligos))


def test_dedup_or_is_greedy_and_and_is_exact(spark):
    reads = spark.createDataFrame([(1, "c", 1, 10), (2, "c", 1, 20), (3, "c", 2, 20), (4, "c", None, 20)], "idx int, CB string, start int, end int")
    assert rows(dedup.deduplicate(reads, "start|end", ("CB",)), "idx", "dc") == [(1, 2), (3, 1), (4, 1)]
    assert rows(dedup.deduplicate(reads, "start&end", ("CB",), keep_unkeyed=False), "idx", "dc") == [(1, 1), (2, 1), (3, 1)]
    with pytest.raises(ValueError):
        dedup.parse_keys("a&|b")


def test_library_complexity(spark):
    got = dedup.library_complexity(spark.createDataFrame([(1000, 800), (5, 5)], "n_total long, n_written long")).collect()
    m = got[0]["complexity"]
    assert abs(m * (1 - 2.718281828459045 ** (-1000 / m)) - 800) < 1e-6 and got[1]["complexity"] is None


def test_interactions(spark):
    counts = spark.createDataFrame([(1, "A", 2), (1, "B", 2), (2, "A", 5), (3, "A", 9), (3, "B", 1)], "cluster int, target string, n long")
    assert rows(interactions.interaction_matrix(counts)) == [("A", "A", 3.0), ("A", "B", 1.0), ("B", "B", 1.0)]
    assert rows(interactions.interaction_matrix(counts, weight="n_over_two")) == [("A", "A", 5.0), ("A", "B", 1.0), ("B", "B", 1.0)]


def test_intervals(spark):
    mask = spark.createDataFrame([("a", 20, 25), ("a", 25, 30), ("b", 1, 2)], "chrom string, start long, end long")
    assert rows(intervals.merge_intervals(mask), "chrom", "start", "end") == [("a", 20, 30), ("b", 1, 2)]
    reads = spark.createDataFrame([("a", 10, 20), ("a", 10, 21), ("c", 1, 2)], "chrom string, start long, end long")
    kept = [("a", 10, 20), ("c", 1, 2)]
    assert rows(intervals.mask(reads, mask)) == kept
    limit, intervals.SMALL_MASK = intervals.SMALL_MASK, 0
    try:
        assert rows(intervals.mask(reads, mask)) == kept and rows(intervals.mask(reads, mask, "inside")) == [("a", 10, 21)]
    finally:
        intervals.SMALL_MASK = limit
    lines = spark.createDataFrame([("a", 0, "ACGTACGT"), ("a", 8, "ACGT")], "chrom string, offset long, seq string")
    cuts = spark.createDataFrame([("a", 2, 4), ("a", 7, 10)], "chrom string, start long, end long")
    assert rows(intervals.hard_mask(lines, cuts), "offset", "seq") == [(0, "ACNNACGN"), (8, "NNGT")]


def test_mask_of_empty_intervals_by_either_join(spark, monkeypatch):
    reads = spark.createDataFrame([("a", 5, 5), ("a", 10, 10), ("a", 20, 30), ("a", 40, 40), ("b", 5, 5)], "chrom string, start long, end long")
    cover = spark.createDataFrame([("a", 0, 10), ("a", 25, 25)], "chrom string, start long, end long")
    for small in (100_000, 0):
        monkeypatch.setattr(intervals, "SMALL_MASK", small)
        kept = {how: sorted((r["chrom"], r["start"]) for r in intervals.mask(reads, cover, how, bin_size=10).collect()) for how in ("outside", "inside")}
        assert kept == {"outside": [("a", 10), ("a", 40), ("b", 5)], "inside": [("a", 5), ("a", 20)]}


def test_barcodes(spark):
    assert len(barcode.hamming_ball("ACGTACGTACGTACG", 2)) == 1741
    config = settings.parse_barcodes("READ1 = DPM\nREAD2 = Y|SPACER|ODD\n# x\nDPM\tDPM1\tAAAA\t0\nY\tY1\tCC\t0\nY\tY2\tCCG\t0\nODD\tO1\tTTTT\t1\n")
    reads = spark.createDataFrame([("AAAAGG", "CCGAAAAAAATTTA"), ("GAAAA", "GG"), ("", None)], "seq1 string, seq2 string")
    got = [r["tags"] for r in barcode.identify(reads, config.layout, config.tags, config.spacer, config.laxity).collect()]
    assert got == [["DPM1", "Y1", "O1"], ["NOT_FOUND"] * 3, ["NOT_FOUND"] * 3]
    named = spark.createDataFrame([("x::[DPM1][Y1][O2]",), ("x::[BEAD_A][Y1][NOT_FOUND]",), ("x::[BEAD_A][Y1][O9]",)], "qname string")
    assert rows(barcode.route(named, {"Y1": [1], "O2": [2], "O9": [1]}), "route") == [("dpm",), ("other",), ("short",)]
    assert rows(barcode.barcode_to_tags(named, 3, reverse=True, clean=True), "qname", "CB")[0] == ("x", "NOT_FOUND.Y1")


def test_chromosomes(spark):
    sizes = [("chr1", 1), ("chr2", 2), ("chr3", 3)]
    assert chrom.reheader(sizes, "coordinate", [("chr2", "b"), ("chr1", "a"), ("chr3", "c")]) == ([("b", 2), ("a", 1), ("c", 3)], "unsorted", {1: 0, 0: 1, 2: 2}, False)
    assert chrom.reheader(sizes, "coordinate", [("chr1", "a"), ("chr3", "c")])[1:] == ("coordinate", {0: 0, 2: 1}, True)
    with pytest.raises(KeyError):
        chrom.reheader(sizes, "unknown", [("chrX", "x")])
    records = spark.createDataFrame([(k, f"read{k}", r, p) for k, r, p in [(1, "ref1", 1), (2, "ref1", 10), (3, "ref2", 20), (4, "ref2", 30), (5, "ref3", 40)]], "idx int, qname string, rname string, pos long")
    out, header, order = chrom.rename_and_sort(records, [("ref1", 100), ("ref2", 150), ("ref3", 200)], "coordinate", [("ref1", "chr1"), ("ref3", "chr3"), ("ref2", "chr2")])
    assert [r["qname"] for r in out.collect()] == ["read1", "read2", "read5", "read3", "read4"] and order == "coordinate" and header[1] == ("chr3", 200)


def test_funnel_and_chunks(spark):
    levels = [("a", None, None), ("b", "a", "a"), ("c", "b", "a")]
    counts = spark.createDataFrame([("s", "a", 10), ("s", "b", 5), ("s", "c", 1)], "sample string, level string, n long")
    got = {r["level"]: r for r in funnel.funnel(counts, levels).collect()}
    assert (got["c"]["frac_parent"], got["c"]["frac_root"], got["a"]["frac_root"]) == (0.2, 0.1, None)
    assert funnel.tree_text(list(got.values()), levels).splitlines()[2].startswith("    c\t1\t0.2")
    parts = [r["chunk"] for r in funnel.chunks(spark.range(9).withColumnRenamed("id", "idx"), 4).orderBy("idx").collect()]
    assert parts == [0, 0, 1, 1, 2, 2, 3, 3, 3]


def test_files(spark, tmp_path):
    path = tmp_path / "x.fq"
    path.write_bytes(gzip.compress(b"@r1 a\nAC\n+\nII\n@r2\nG\n+\nI\n@cut\nA\n"))
    assert rows(text.read_fastq(spark, str(path)), "idx", "qname", "seq") == [(0, "r1 a", "AC"), (1, "r2", "G")]
    assert rows(text.read_pairs(spark, [str(path)], [str(path)]), "idx", "seq1", "seq2") == [(0, "AC", "AC"), (1, "G", "G")]
    sam = tmp_path / "x.sam"
    sam.write_text("@HD\tVN:1.6\nr\t0\tref1\t5\t30\t3S4M1D2M\t*\t0\t0\tACGT\t*\tRT:Z:DPM1\n")
    records = text.read_sam(spark, str(sam))
    assert rows(records, "ref_start", "ref_end") == [(4, 11)]
    assert text.sam_lines(records).first()["value"] == sam.read_text().splitlines()[1]
    fasta = tmp_path / "x.fa"
    fasta.write_text(">a one\nAC\nGT\n>b\nNN\n")
    assert rows(text.read_fasta(spark, str(fasta))) == [("a", "ACGT"), ("b", "NN")]


def test_settings():
    assert settings.parse_format("-1\tX\n2\tX\n1\tX\n") == {"X": [-1, 1, 2]}
    assert settings.parse_chrom_map('"note\na\tb\nc\td\n') == [("a", "b"), ("c", "d")]
    with pytest.raises(ValueError):
        settings.parse_chrom_map("a\tb\na\tc\n")
    with pytest.raises(ValueError):
        settings.Settings(num_chunks=100)


def test_validation(tmp_path):
    for wrong in ("DPM\tX1\tAAAA\t0", "DPM\tDPMBEAD1\tAAAA\t0", "Y\tBEAD_1\tCC\t0", "Y\tDPM1\tCC\t0"):
        with pytest.raises(ValueError, match="is no name of"):
            settings.parse_barcodes(f"READ1 = DPM\n{wrong}\n")
    assert settings.parse_barcodes("READ1 = DPM\nDPM\tBEAD_DPM\tAAAA\t0\n").targets() == ["DPM"]
    plain, zipped = tmp_path / "a.fq", tmp_path / "a.fq.gz"
    plain.write_text("@r\nA\n+\nI\n")
    zipped.write_bytes(gzip.compress(plain.read_bytes()))
    assert settings.not_gzip({"s": {"R1": [str(zipped)], "R2": [str(plain)]}}) == [str(plain)]
    levels = {"data": {}, "trimmed": {"path": ["trim", "{sample}.fastq.gz"], "parent": "data", "base": None}}
    assert settings.level_faults(levels) == []
    assert settings.level_faults(levels | {"a": {"path": ["x.txt"], "parent": "none"}, "b": {"base": "other"}}) == [
        "a has a path of no known kind: x.txt", "a has the unknown parent none", "b has no path", "b has the unknown base other",
    ]
    assert settings.missing_keys({"samples": 1}, ("scripts", "samples")) == ["scripts"]


def test_fastq_keeps_what_follows_an_empty_read(spark, tmp_path):
    path = tmp_path / "a.fq"
    path.write_text("@r1\nAC\n+\nII\n@r2\n\n+\n\n@r3\nG\n+\nI\n\n")
    assert rows(text.read_fastq(spark, str(path)), "qname", "seq") == [("r1", "AC"), ("r2", ""), ("r3", "G")]
    path.write_text("@r1\nAC\n+\nI\n")
    with pytest.raises(Exception, match="no FASTQ record"):
        text.read_fastq(spark, str(path)).collect()


def test_bed_lines_are_intervals_or_errors(spark, tmp_path):
    path = tmp_path / "a.bed"
    path.write_text("track name=x\n#c\nchr1\t1\t5\textra\n\n")
    assert rows(text.read_bed(spark, str(path))) == [("chr1", 1, 5)]
    path.write_text("chr1\t1\n")
    with pytest.raises(Exception, match="no BED line"):
        text.read_bed(spark, str(path)).collect()


def test_index_summary_and_header(spark, tmp_path):
    path = tmp_path / "s.txt"
    path.write_text("Colorspace\t0\nSequence-1\tchr1 some words\t195\nSequence-2\tchr2\t20\n")
    assert rows(text.read_index_summary(spark, str(path))) == [("chr1", 195), ("chr2", 20)]
    path.write_text("@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:195\n")
    assert rows(text.header_sizes(text.read_sam_header(spark, str(path)))) == [("chr1", 195)]


def test_positions_belong_to_a_chromosome(spark):
    reads = spark.createDataFrame([(1, "c", "chr1", 5, 9), (2, "c", "chr2", 5, 9), (3, "c", "chr2", 5, 9)], "idx int, CB string, rname string, start int, end int")
    assert rows(dedup.deduplicate(reads, "start&end", ("CB",)), "idx", "dc") == [(1, 1), (2, 2)]
    assert rows(dedup.deduplicate(reads, "start|end", ("CB",)), "idx", "dc") == [(1, 1), (2, 2)]
    assert rows(dedup.deduplicate(reads, "start|end"), "idx", "dc") == [(1, 1), (2, 2)]


def test_large_ids_stay_beside_nulls(spark):
    big = 2**53 + 1
    reads = spark.createDataFrame([(1, "c", 1, 1, big), (2, "c", 2, 2, None)], "idx int, CB string, a int, b int, other long")
    assert rows(dedup.deduplicate(reads, "a|b", ("CB",)), "idx", "other", "dc") == [(1, big, 1), (2, None, 1)]


def test_dedup_by_alternatives_is_brute_force(spark):
    from brindle.plans.catalog import QUERIES

    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").collect()
    order = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    want, groups = [], {}
    for r in sorted(lines, key=lambda r: tuple(r[c] for c in order)):
        groups.setdefault(r["l_orderkey"], []).append(r)
    for found in groups.values():
        kept = []
        for r in found:
            hit = next((k for k in kept if k[0]["l_suppkey"] == r["l_suppkey"]), None) or next((k for k in kept if k[0]["l_partkey"] == r["l_partkey"]), None)
            if hit is None:
                kept.append([r, 1])
            else:
                hit[1] += 1
        want += [(k["l_orderkey"], *(k[c] for c in order), n) for k, n in kept]
    got = QUERIES["dedup_or_keys"](spark, "/root/testdata/sf0.001")
    assert rows(got, "l_orderkey", *order, "dc") == sorted(want)


def test_share_is_rounded(spark):
    made = spark.createDataFrame([("x", 2, 3), ("x", 5, 6), ("x", 6, 7), ("x", 1, 8), ("x", 1, 40), ("y", 0, 0)], "label string, mode_count long, n_oligo long")
    got = {(label, value): n for label, metric, value, n in rows(clusters.max_representation(made)) if metric == "proportion"}
    assert got == {("x", 67): 1, ("x", 83): 1, ("x", 86): 1, ("x", round(100 * round(1 / 8, 2))): 1, ("x", round(100 * round(1 / 40, 2))): 1, ("y", 0): 1}


def test_merge_across_spans_and_hard_mask(spark):
    spans = spark.createDataFrame([("a", 0, 25), ("a", 8, 9), ("a", 20, 30), ("a", 31, 35), ("b", 5, 6)], "chrom string, start long, end long")
    for span in (10, 1_000_000):
        assert rows(intervals.merge_intervals(spans, span=span), "chrom", "start", "end") == [("a", 0, 30), ("a", 31, 35), ("b", 5, 6)]
    lines = spark.createDataFrame([("a", 24, "acgtacgtac"), ("b", 0, "acgt"), ("c", 0, "ac")], "chrom string, offset long, seq string")
    assert rows(intervals.hard_mask(lines, spans, bin_size=4)) == [("a", 24, "NNNNNNgNNN"), ("b", 0, "acgt"), ("c", 0, "ac")]


def test_concatenated_samples_have_one_genome(spark):
    records, sizes = spark.createDataFrame([("r",)], "qname string"), spark.createDataFrame([("chr1", 5)], "chrom string, length long")
    assert rows(clusters.concatenated({"a": (records, sizes), "b": (records, sizes)})) == [("r", "a"), ("r", "b")]
    with pytest.raises(ValueError):
        clusters.concatenated({"a": (records, sizes), "b": (records, sizes.limit(0))})


def test_configurations_and_names(tmp_path):
    (tmp_path / "c.json").write_text('{"a": [1]}')
    assert settings.load_config(str(tmp_path / "c.json")) == {"a": [1]}
    (tmp_path / "c.yaml").write_text("a:\n- 1\n")
    try:
        assert settings.load_config(str(tmp_path / "c.yaml")) == {"a": [1]}
    except ValueError as e:
        assert "no library" in str(e)
    settings.write_config({"b": 1, "a": None}, str(tmp_path / "d.json"))
    assert settings.load_config(str(tmp_path / "d.json")) == {"a": None, "b": 1}
    assert settings.long_names(["s" * 214], ["t" * 13]) == [] and len(settings.long_names(["s" * 215], ["t" * 13, "a b"])) == 3
    assert settings.long_names(["s" * 214], ["t" * 14], split=False) == []
    assert settings.without({"sample": ["a", "b"], "x": ["c"]}, {"sample": ["a"]}) == {"sample": ["b"], "x": ["c"]}
    with pytest.raises(ValueError, match="no category"):
        settings.parse_barcodes("READ1 = DPM|WRONG\nDPM\tDPM1\tAAAA\t0\n")


def test_funnel_files_and_orders(spark, tmp_path):
    levels = [("a", None, None), ("b", "a", "a")]
    counts = spark.createDataFrame([("s", "b", 5), ("s", "a", 10)], "sample string, level string, n long")
    funnel.write_funnel(funnel.funnel(counts, levels), str(tmp_path / "f"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "f")).collect()][:2] == ["sample,level,depth,n,frac_parent,frac_base,frac_root", "s,a,0,10,,,"]
    funnel.write_counts(spark.createDataFrame([("b", "y", 2), ("a", "x", 1)], "level string, path string, count long"), str(tmp_path / "r"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "r")).collect()] == ["level,path,count", "a,x,1", "b,y,2"]
    made = clusters.reads_per_cluster(spark.createDataFrame([("b", 1, 2), ("a", 3, 0)], "label string, n_dpm long, n_oligo long"))
    order = [tuple(r)[:3] for r in clusters.in_order(made).collect()]
    assert order == sorted(order)


def test_tags_that_collide(spark):
    tags = spark.createDataFrame([("Y", "Y1", "AC", 1, 0), ("Y", "Y2", "CC", 0, 1), ("Z", "Z1", "CC", 0, 2)], "category string, name string, seq string, mismatches int, place long")
    assert rows(barcode.ambiguous(tags)) == [("Y", "CC", 2)]
    assert {(r["category"], r["seq"]): r["name"] for r in barcode.expanded(tags).collect()}["Y", "CC"] == "Y2"


def test_close_tags_of_all_lengths_and_copies(spark, monkeypatch):
    rng = random.Random(5)
    near = lambda seq: "".join(rng.choice("ACGT") if rng.random() < 0.2 else c for c in seq)
    base = ["".join(rng.choice("ACGT") for _ in range(n)) for n in (0, 1, 2, 3, 5, 8, 13, 40)]
    # Names repeat, with one sequence and with several, and one sequence has very many names.
    made = [(rng.randrange(60), near(rng.choice(base))) for _ in range(100)] + [(k, "ACGTACGT") for k in range(40)] + [(None, "ACGTACGT"), (1, None)]
    monkeypatch.setattr(barcode, "BLOCK", 7)
    tags = spark.createDataFrame(made, "name long, seq string")
    whole = [(n, s) for n, s in made if n is not None and s is not None]
    for radius in (0, 1, 2, 4):
        want = []
        for one, a in whole:
            for two, b in whole:
                if one < two and len(a) == len(b) and (apart := sum(x != y for x, y in zip(a, b))) <= radius:
                    want.append((one, two, apart))
        assert rows(barcode.close_tags(tags, radius), "one", "two", "apart") == sorted(want), radius


def test_close_tags_compare_a_sequence_once(spark):
    # 300 copies of 20 sequences: copies are paired, but not compared.
    tags = spark.range(6000).selectExpr("id AS name", "lpad(conv(cast(id % 20 AS string), 10, 4), 8, '0') AS seq")
    text = barcode.close_tags(tags, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Distinct" not in text and "Aggregate [one" not in text
    assert barcode.close_tags(tags.where("id < 20"), 2).count() * 300 * 300 + 20 * 300 * 299 // 2 == barcode.close_tags(tags, 2).count()
