"""Files by ranges: the same records however a file is cut."""

import gzip
import json
import pickle
import random

import pyarrow as pa
import pytest

from brindle.operators import intervals
from brindle.sources import bam, ranges, text


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_fastq_is_cut_anywhere(spark, tmp_path):
    rng = random.Random(0)
    want = []
    for k in range(80):
        seq = "".join(rng.choice("ACGTN") for _ in range(rng.randrange(9)))
        want.append((f"r{k} x", seq, "+", "".join(rng.choice("@+I#>") for _ in seq)))
    path = tmp_path / "a.fq"
    path.write_text("".join(f"@{n}\n{s}\n{p}\n{q}\n" for n, s, p, q in want))
    for split in (1, 2, 5, 30, 1000, 10**6):
        got = []
        for _, p, start, end in ranges.cut([str(path)], split):
            first, _, n = ranges.fastq_range(p, start, end)
            got += ranges.fastq_records(p, first, n, 0) if n else []
        assert [tuple(x.decode() for x in r) for r in got] == want, split
    df = ranges.read_fastq(spark, str(path), split=200)
    assert df.rdd.getNumPartitions() >= 4
    assert [tuple(r) for r in df.orderBy("idx").select("idx", "qname", "seq", "qual").collect()] == [(k, n, s, q) for k, (n, s, _, q) in enumerate(want)]


def test_pairs_meet_without_a_shuffle(spark, tmp_path):
    rng = random.Random(1)
    lines = lambda n, size: "".join(f"@p{k}\n{'ACGT' * (k % size)}\n+\n{'@I+#' * (k % size)}\n" for k in range(n))
    one, two, three = tmp_path / "1.fq", tmp_path / "2.fq", tmp_path / "3.fq.gz"
    one.write_text(lines(200, 5))
    two.write_text(lines(150, 40))
    three.write_bytes(gzip.compress(lines(120, 3).encode()))
    df = ranges.read_pairs(spark, [str(one), str(one)], [str(two), str(three)], split=rng.randrange(300, 900))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString() and df.rdd.getNumPartitions() > 4
    assert rows(df, "pair", "idx", "qname", "seq1", "seq2") == sorted((p, k, f"p{k}", "ACGT" * (k % 5), "ACGT" * (k % m)) for p, n, m in ((0, 150, 40), (1, 120, 3)) for k in range(n))
    with pytest.raises(ValueError):
        ranges.read_pairs(spark, [str(one)], [str(two), str(two)])


def test_fasta_windows(spark, tmp_path):
    rng = random.Random(2)
    made = {f"c{k}": "".join(rng.choice("ACGTacgtN") for _ in range(rng.randrange(300))) for k in range(8)} | {"none": ""}
    body = ""
    for name, seq in made.items():
        width = rng.choice([7, 50, 1000])
        body += f">{name} about x>y\n" + "".join(seq[i : i + width] + "\n" for i in range(0, len(seq), width))
    plain, zipped = tmp_path / "a.fa", tmp_path / "a.fa.gz"
    plain.write_text(body)
    zipped.write_bytes(gzip.compress(body.encode()))
    assert dict(rows(text.read_fasta(spark, str(plain)))) == made
    for path, split in ((plain, 64), (plain, 10**6), (zipped, 64)):
        df = ranges.read_fasta_windows(spark, str(path), window=16, split=split)
        found = {}
        for chrom, offset, seq in rows(df):
            assert offset == len(found.get(chrom, "")) and 0 < len(seq) <= 16
            found[chrom] = found.get(chrom, "") + seq
        assert found == {n: s for n, s in made.items() if s}
    assert ranges.read_fasta_windows(spark, str(plain), split=64).rdd.getNumPartitions() > 4
    masked = intervals.hard_mask(ranges.read_fasta_windows(spark, str(plain), window=16, split=64), spark.createDataFrame([("c0", 3, 40)], "chrom string, start long, end long"))
    left = "".join(s for c, _, s in rows(masked) if c == "c0")
    assert left == made["c0"][:3] + "N" * (min(40, len(made["c0"])) - 3) + made["c0"][40:]
    plain.write_text("ACGT\n>a\nAC\n")
    with pytest.raises(Exception, match="before the first header"):
        ranges.read_fasta_windows(spark, str(plain)).collect()


def test_fasta_is_cut_anywhere(tmp_path, monkeypatch):
    rng = random.Random(4)
    made = [(f"c{k}", "".join(rng.choice("ACGTacgtN") for _ in range(rng.randrange(60)))) for k in range(40)]
    body = "".join(f">{n} x>y {'about ' * (k % 9)}\r\n" + "".join(s[i : i + 7] + rng.choice(["\n", "\r\n", " \n\n"]) for i in range(0, len(s), 7)) for k, (n, s) in enumerate(made))
    path = tmp_path / "a.fa"
    path.write_bytes(body.rstrip().encode())
    for block in (1, 3, 17, 1 << 20):
        monkeypatch.setattr(ranges, "BLOCK", block)
        for split in (1, 2, 13, 64, 10**6):
            found = []
            for _, p, a, b in ranges.cut([str(path)], split):
                for name, bases in ranges.fasta_parts(p, a, b):
                    found.append([name, ""]) if name is not None else found[-1].__setitem__(1, found[-1][1] + bases.decode())
            assert [tuple(x) for x in found] == made, (block, split)


def test_ranges_grow_with_files_and_tasks_get_their_own(spark, tmp_path, monkeypatch):
    from brindle.plans import files

    cores, path = spark.sparkContext.defaultParallelism, tmp_path / "a.fa"
    for size, n in ((1 << 14, 1), (1 << 16, 4), (3 << 20, ranges.SHARES * cores)):
        path.write_bytes(b">a\n" + b"A" * (size - 3))
        assert len(ranges.cut([str(path)], ranges.split_for(spark, str(path), least=1 << 14))) in (n, n + 1)
    assert ranges.split_for(spark, str(path), least=1, most=100) == 100
    sent = [len(pickle.dumps(ranges._FastaReader({"ranges": json.dumps([("/a", k, k + 1, None, 0) for k in range(n)]), "window": "256"}))) for n in (1, 10_000)]
    assert sent[0] == sent[1]
    seen, read = [], ranges.read_fasta_windows
    monkeypatch.setattr(ranges, "read_fasta_windows", lambda *a, **b: seen.append(read(*a, **b)) or seen[-1])
    files.fasta_hard_mask(spark, "/root/testdata/sf0.1")
    # Every file written ends a range, too.
    assert seen[0].rdd.getNumPartitions() <= (ranges.SHARES + 1) * cores


HEADER = ["@HD\tVN:1.6", "@SQ\tSN:chr1\tLN:100000", "@SQ\tSN:chr2\tLN:50"]
TYPED = {"NM": ("i", "-3"), "XU": ("i", "4000000000"), "XF": ("f", "1.5"), "XA": ("A", "q"), "XZ": ("Z", "two words"), "XH": ("H", "1AE3"), "XB": ("B", "c,-1,2"), "XG": ("B", "f,0.5,2"), "XS": ("B", "S,1,65535")}


def record(k, seq="ACGTN", **more):
    own = {"qname": f"r{k}", "flag": k % 7, "rname": "chr1", "pos": k + 1, "mapq": 30, "cigar": f"{len(seq)}M" if seq != "*" else "*", "rnext": "=", "pnext": 5, "tlen": -4, "seq": seq, "qual": "I" * len(seq) if seq != "*" else "*", "tags": [("RT", "DPM1")], "types": [("RT", "Z")]}
    return own | more


def as_batch(records):
    kinds = [f for f in bam.SCHEMA if f.name in records[0]]
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in records], f.type) for f in kinds], schema=pa.schema(kinds))


def test_bam_is_cut_anywhere(tmp_path):
    rng = random.Random(3)
    made = [record(k, "".join(rng.choice("ACGTN") for _ in range(rng.randrange(1, 300)))) for k in range(1500)]
    made[700] = record(700, "".join(rng.choice("ACGT") for _ in range(300_000)))  # over several blocks
    made[3] = record(3, "*", rname="*", pos=0, rnext="*", pnext=0, tlen=0, flag=4, mapq=0)
    made[4] = record(4, "ACG", qual="*", cigar="1S2M3D4N5I6H", tags=sorted((t, v) for t, (_, v) in TYPED.items()), types=sorted((t, k) for t, (k, _) in TYPED.items()))
    writer = bam._BamWriter({"path": str(tmp_path), "header": "\n".join(HEADER) + "\n"})
    writer.commit([writer.write(iter([as_batch(made[:900]), as_batch(made[900:])]))])
    (path,) = bam.files_of(str(tmp_path))
    assert bam.bam_header(path) == HEADER
    size = len(open(path, "rb").read())
    names = [f.name for f in bam.SCHEMA]
    for split in (size, 70_001, 20_011, 9_973):
        got = [dict(zip(names, r)) for a in range(0, size, split) for r in bam.records_of(path, a, min(a + split, size))]
        assert [{c: r[c] for c in made[0]} for r in got] == made, split
    assert (got[4]["ref_start"], got[4]["ref_end"]) == (4, 4 + 2 + 3 + 4) and (got[3]["ref_start"], got[3]["ref_end"]) == (-1, -1)


def test_bam_records_together_are_those_one_by_one(tmp_path, monkeypatch):
    rng = random.Random(6)
    places, names = {"chr1": 0, "chr2": 1}, ["chr1", "chr2"]
    plain = {"NM": "i", "XU": "i", "XA": "A", "XZ": "Z", "XH": "H"}

    def some(k):
        seq = "".join(rng.choice("ACGTNacgt=") for _ in range(rng.randrange(40))) or "*"
        tags = rng.sample(sorted(plain), rng.randrange(6))
        more = {"qual": rng.choice(["*", "".join(chr(rng.randrange(33, 127)) for _ in seq)]) if seq != "*" else "*", "rname": rng.choice(["chr1", "chr2", "*"]), "rnext": rng.choice(["=", "*", "chr2"]), "pos": rng.randrange(1 << rng.randrange(1, 29)), "cigar": rng.choice(["*", "3M2I", "1S200000N4X5="])}
        return record(k, seq, **more, tags=[(t, TYPED[t][1] if rng.random() < 0.5 or t == "XA" else "12") for t in tags], types=[(t, plain[t]) for t in reversed(tags)])

    made = [some(k) for k in range(300)]
    whole = as_batch(made)
    for batch in (whole, whole.slice(17, 101), whole.slice(299), whole.slice(0, 0)):
        want = b"".join(bam.encoded(r, places) for r in batch.to_pylist())
        assert bam._encoded_plain(batch, places) == want == bam.encoded_together(batch, places)
        at, bodies = 0, []
        while at < len(want):
            bodies.append((at + 4, int.from_bytes(want[at : at + 4], "little")))
            at += 4 + bodies[-1][1]
        if bodies:
            slow, monkey = [bam.decoded(want, a, n, names) for a, n in bodies], bam.decoded
            monkeypatch.setattr(bam, "decoded", None)  # not one of them is decoded alone
            assert list(zip(*(c.to_pylist() for c in bam.decoded_together(want, [a for a, _ in bodies], names).columns))) == slow
            monkeypatch.setattr(bam, "decoded", monkey)
    # What numpy does not write is written, or refused, as before.
    for odd in (record(1, "ACG", qual="II"), record(1, tags=[("XF", "1.5")], types=[("XF", "f")]), record(1, tags=[("XB", "c,-1,2")], types=[("XB", "B")]), record(1, tags=[("NM", "+5")], types=[("NM", "i")])):
        assert bam.encoded_together(as_batch([odd]), places) == bam.encoded(odd, places)
    for wrong in (record(1, rname="chrX"), record(1, flag=1 << 17), record(1, qual="II II"), record(1, "AC!GT"), record(1, tags=[("NM", "x")], types=[("NM", "i")])):
        with pytest.raises(Exception) as one:
            bam.encoded(wrong, places)
        with pytest.raises(one.type):
            bam.encoded_together(as_batch([wrong]), places)


def test_bam_through_spark(spark, tmp_path):
    columns = ", ".join(c for c in bam.COLUMNS.split(", ") if not c.startswith("ref_"))
    records = spark.createDataFrame([tuple((dict(v) if isinstance(v, list) else v) for v in record(k, "ACGT" * 50).values()) for k in range(4000)], columns)
    bam.write_bam(records.coalesce(1), HEADER, str(tmp_path / "b"))
    back = bam.read_bam(spark, str(tmp_path / "b"), split=10_000)
    assert back.rdd.getNumPartitions() >= 4 and len(bam.files_of(str(tmp_path / "b"))) == 1
    show = ("qname", "flag", "pos", "cigar", "seq", "qual", "tags", "types")
    plain = lambda df: sorted(map(str, df.select(*show).collect()))
    assert plain(back) == plain(records)
    bam.write_bam(records.limit(0), HEADER, str(tmp_path / "none"))
    assert bam.read_bam(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="chrX"):
        bam.write_bam(records.selectExpr("*").replace("chr1", "chrX", ["rname"]), HEADER, str(tmp_path / "x"))


def test_sam_tag_that_is_repeated(spark, tmp_path):
    path = tmp_path / "x.sam"
    path.write_text("r\t0\tref1\t5\t30\t3M\t*\t0\t0\tACG\t*\tRT:Z:one\tNM:i:1\tRT:Z:two\n")
    got = text.read_sam(spark, str(path)).first()
    assert got["tags"] == {"RT": "one", "NM": "1"} and got["types"] == {"RT": "Z", "NM": "i"}
