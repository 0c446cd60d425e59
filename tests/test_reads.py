"""Single reads: trims by brute force, names without barcodes, unmapped reads, alternatives over a whole table."""

import random

import pytest

from brindle.operators import barcode, clusters, dedup, trim


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(line[j - 1] + (x != y), line[j] + 1, new[-1] + 1))
        line = new
    return line[-1]


def best_cut(read, three, five, error, overlap):
    """Every alignment of every adapter: (place, low, high) of the best."""
    found = []
    for place, (adapter, rev) in enumerate([(a, False) for a in three] + [(a[::-1], True) for a in five]):
        own = read[::-1] if rev else read
        for s in range(len(own) + 1):
            for e in range(s, len(own) + 1):
                for i in range(overlap, len(adapter) + 1):
                    if i < len(adapter) and e < len(own) or abs(i - (e - s)) > int(error * i + 1e-9):
                        continue
                    d = distance(adapter[:i], own[s:e])
                    if d <= int(error * i + 1e-9):
                        found.append((-(i - 2 * d), place, s, rev))
    if not found:
        return -1, 0, len(read)
    _, place, s, rev = min(found)
    return (place, len(read) - s, len(read)) if rev else (place, 0, s)


def test_best_adapters_are_brute_force():
    rng = random.Random(4)
    three, five = ["GATCGGAAGAG", "ATCAGCACTTA", "CCC"], ["TGGGTGTTTT", "TCGAGTCTTT"]

    def edited(s):
        s = list(s)
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(s))
            s[k : k + 1] = rng.choice([[], [rng.choice("ACGT")], [s[k], rng.choice("ACGT")]])
            s = s or ["A"]
        return "".join(s)

    reads = ["", "A", "GAT", "TTT"]
    for _ in range(60):
        dna = "".join(rng.choice("ACGTN") for _ in range(rng.randrange(12)))
        kind = rng.randrange(4)
        reads.append(dna + edited(rng.choice(three)) + dna[:4] if kind == 0 else edited(rng.choice(five))[rng.randrange(6) :] + dna if kind == 1 else dna + edited(rng.choice(three))[: rng.randrange(3, 9)] if kind == 2 else dna)
    for error in (0.1, 0.2, 0.0):
        made = [(trim.Adapter(a, error, 3), False) for a in three] + [(trim.Adapter(a[::-1], error, 3), True) for a in five]
        got = list(zip(*(x.tolist() for x in trim.best_adapters(reads, made))))
        assert got == [best_cut(r, three, five, error, 3) for r in reads]


def test_trims(spark):
    reads = spark.createDataFrame([("ACGTACGTACGTACGTACGTACGTGATCGGAAGAGCC", "I" * 37), (None, None), ("", "")], "seq string, qual string")
    assert rows(trim.trim_adapters(reads, ["GATCGGAAGAG"], found="adapter")) == [("ACGTACGTACGTACGTACGTACGT", "I" * 24, "GATCGGAAGAG")]
    assert trim.trim_adapters(reads, ["GATCGGAAGAG"], least=0).count() == 3
    assert rows(trim.trim_quality(spark.createDataFrame([("ACGTAC", "IIII##"), ("", "")], "seq string, qual string")), "seq") == [("",), ("ACGT",)]
    assert rows(trim.trim_anchored(reads.where("seq <> ''"), ["ACG", "ACGTA"]), "seq")[0][0].startswith("CGTACG")
    with pytest.raises(ValueError):
        trim.trim_adapters(reads, [""])


def test_pairs_go_together(spark):
    good, bad = "ACGT" * 6, "ACGT" * 2
    pairs = spark.createDataFrame([(1, good + "GATCGGAAGAG", "I" * 35, good, "I" * 24), (2, good, "I" * 24, bad, "I" * 8), (3, good, "I" * 24, good, "I" * 19 + "#" * 5)], "k int, seq1 string, qual1 string, seq2 string, qual2 string")
    assert rows(trim.trim_pairs(pairs, ["GATCGGAAGAG"], overlap=3), "k", "seq1", "qual2") == [(1, good, "I" * 24)]


def test_names_without_barcode(spark):
    names = spark.createDataFrame([("a::[DPM1][Y1] 1:N",), ("b",), ("c[DPM1][Y1]",), ("d::[RPM][Y1]",), ("e::[DPM1]",), (None,)], "qname string")
    assert rows(barcode.barcode_to_tags(names, 2)) == [("a 1:N", "DPM1", "Y1")]
    assert rows(barcode.tags_found(names.where("qname IS NOT NULL")), "n_found", "n_reads") == [(0, 1), (1, 1), (2, 3)]
    assert rows(barcode.positions_found(names)) == [(0, 4), (1, 3)]
    with pytest.raises(Exception, match="no barcode in b"):
        barcode.route(names.where("qname = 'b'")).collect()
    tagged = spark.createDataFrame([("a::[DPM1][Y1]", {"RT": "old", "NM": "3"}, {"RT": "i", "NM": "i"})], "qname string, tags map<string,string>, types map<string,string>")
    got = barcode.barcode_to_tags(tagged, 2, add_tags=["XX:i:5"], tag_barcode="BC").first()
    assert got["tags"] == {"RT": "DPM1", "NM": "3", "BC": "Y1", "XX": "5"} and got["types"] == {"RT": "Z", "NM": "i", "BC": "Z", "XX": "i"}
    with pytest.raises(ValueError):
        barcode.parse_tags(["XYZ:i:5"])


def test_labels_skip_other_types(spark):
    reads = spark.createDataFrame([("c", "RPM"), ("c", "BEAD_A"), ("c", "DPM1"), ("c", None)], "cluster string, read_type string")
    labels = spark.createDataFrame([("c", "A", 1)], "cluster string, label string, n_dpm long")
    assert sorted(r["read_type"] for r in clusters.label_reads(reads, labels).collect()) == ["BEAD_A", "DPM1"]


def test_unmapped_reads_are_never_copies(spark):
    reads = spark.createDataFrame([(k, "c", name, at, at) for k, (name, at) in enumerate([("*", -1), ("*", -1), ("chr1", 5), ("chr1", 5), ("chr1", -1)])], "idx int, CB string, rname string, ref_start long, ref_end long")
    for by in ("start&end", "start|end"):
        assert rows(dedup.deduplicate(reads, by, ("CB",)), "idx", "dc") == [(0, 1), (1, 1), (2, 2), (4, 1)]
        assert rows(dedup.deduplicate(reads, by, ("CB",), keep_unkeyed=False), "idx", "dc") == [(2, 2)]


def in_order(reads):
    seen, kept = {}, {}
    for r in sorted(reads):
        keys = [(r[1], *k) for k in (("a", r[2]), ("b", r[3]))]
        hit = next((seen[k] for k in keys if k in seen), None)
        if hit is None:
            kept[r[0]] = 1
            seen.update((k, r[0]) for k in keys)
        else:
            kept[hit] += 1
    return sorted(kept.items())


@pytest.mark.parametrize("limit", [20, 200_000])
def test_alternatives_over_a_whole_table(spark, monkeypatch, limit):
    monkeypatch.setattr(dedup, "IN_ORDER", limit)
    rng = random.Random(2)
    # One value in a third of all rows, and a small cluster beside the large one.
    made = [(k, "x", 0 if rng.random() < 0.3 else rng.randrange(90), rng.randrange(90)) for k in range(400)] + [(k + 400, "y", rng.randrange(3), rng.randrange(3)) for k in range(15)]
    reads = spark.createDataFrame([(k, g, f"a{a}", f"b{b}") for k, g, a, b in made], "idx int, CB string, a string, b string")
    assert rows(dedup.deduplicate(reads, "a|b", ("CB",)), "idx", "dc") == in_order(made)
    assert rows(dedup.deduplicate(reads, "a|b"), "idx", "dc") == in_order([(k, "", a, b) for k, _, a, b in made])


def test_equal_values_of_two_tags_are_one_key(spark):
    reads = spark.createDataFrame([(1, "u", "v"), (2, "w", "u")], "idx int, RX string, RY string")
    assert rows(dedup.deduplicate(reads, "RX|RY"), "idx", "dc") == [(1, 2)]


@pytest.mark.parametrize("few", [2, 1 << 20])
def test_whole_tables_are_judged_by_summaries_of_keys(spark, monkeypatch, few):
    for limit in ("IN_ORDER", "BROADCAST", "HASHES"):
        monkeypatch.setattr(dedup, limit, few if limit != "IN_ORDER" else 10)
    sizes, write = {}, dedup.written

    def written(df, name):
        out = write(df, name)
        sizes[name] = sizes.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(dedup, "written", written)
    rng = random.Random(3)
    # Keys that rise with the order, as in sorted reads; a key of very many; values that both columns have.
    made = [(k, "", f"v{k // 100 * 5 + rng.randrange(5)}", f"v{rng.choice([0, k // 100 * 20 + rng.randrange(20)])}") for k in range(800)]

    def judged(first, second):
        seen, kept = {}, {}
        for r in made:
            hit = next((seen[r[c]] for c in (first, second) if r[c] in seen), None)
            if hit is None:
                kept[r[0]] = 1
                seen.update({r[2]: r[0], r[3]: r[0]})
            else:
                kept[hit] += 1
        return sorted(kept.items())

    reads = spark.createDataFrame([(k, a, b) for k, _, a, b in made], "idx int, a string, b string")
    assert rows(dedup.deduplicate(reads, "a|b"), "idx", "dc") == judged(2, 3)
    assert rows(dedup.deduplicate(reads, "b|a"), "idx", "dc") == judged(3, 2)
    sizes.clear()
    apart = reads.selectExpr("idx", "concat('a', a) AS a", "concat('b', b) AS b")
    assert rows(dedup.deduplicate(apart, "a|b"), "idx", "dc") == in_order(made)
    # Besides the reads themselves, what is written is less than they are.
    assert sum(n for name, n in sizes.items() if name != "reads") < len(made) == sizes["reads"]


def test_multiplicity_file_has_no_header(spark, tmp_path):
    dedup.write_multiplicity(spark.createDataFrame([(2,), (1,), (2,)], "dc long"), str(tmp_path / "h"))
    assert spark.read.text(str(tmp_path / "h")).collect()[0][0] == "1\t1"
