"""The operators against brute force, over hostile small tables and the smallest given ones."""

import collections
import hashlib
import json
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from brindle.llm import ann, html_tree, isolation, jaccard, licenses, lm_scoring, mixing, packing, quality_qda, queries, substring

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, label int"
LONG = " ".join(f"w{k}" for k in range(3000))
BASE = " ".join(f"v{k}" for k in range(60))


def docs(spark, rows=None):
    """Nulls, empty, very long, tied and repeated rows, and columns whose names clash."""
    odd = [(1, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE.upper() + " tail", None, None), (4, None, "en", "b"), (5, "", "en", "b"), (6, " \t\n", "en", "b"), (7, LONG, "de", "c"), (8, LONG + " more", "de", "c"), (9, "one", "de", "c"), (10, "ONE", "de", "c"), (10, "ONE", "de", "c"), (11, "a a a a a a a a a a a a a a a a a a a a", "fr", ""), (12, "x " * 13 + BASE, "fr", "a"), (None, "lost", "fr", "a"), (13, "nul é <|endoftext|> 🙂", "fr", "a")]
    rows = odd if rows is None else rows
    return spark.createDataFrame([(*r, 0, "clash", 1) for r in rows], SCHEMA)


def given(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}


def shingles(text, n):
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def components(sets, percent):
    ids, root = sorted(sets), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80), (2, 50)])
@pytest.mark.parametrize("table", ["odd", "given"])
def test_jaccard(spark, table, n, percent):
    df = docs(spark) if table == "odd" else given(spark, "documents")
    sets = {i: shingles(t, n) for i, t in texts(df).items()}
    want = components(sets, percent)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.ngram_jaccard_join(df, n, percent).collect()}
    assert got == {(i, len(sets[i]), want[i]) for i in sets}


def test_fragments_of_strangers():
    """Unrelated sets share no key, also where some of their fragments are empty."""
    rng, seen = np.random.default_rng(4), {}
    for percent, size in ((80, 60), (80, 1000), (80, 3000), (90, 300)):
        for k in range(20):
            for key in jaccard.fragment_keys(np.unique(rng.integers(0, 2**64, size, dtype=np.uint64)), percent).tolist():
                assert seen.setdefault(key, (size, k, percent)) == (size, k, percent)


def test_jaccard_ids_of_several_texts(spark):
    """A repeated id links by any of its texts."""
    other = " ".join(f"o{k}" for k in range(60))
    rows = [(1, BASE, "", ""), (5, BASE + " x", "", ""), (5, other, "", ""), (9, other + " y", "", ""), (20, "z z z z", "", "")]
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard.ngram_jaccard_join(docs(spark, rows), 3, 90).collect())
    assert got == [(1, 1), (5, 1), (5, 1), (9, 1), (20, 20)]


def test_jaccard_large_group_of_near_copies(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        w = [f"t{k}" for k in range(120)]
        for k in rng.choice(120, int(rng.integers(1, 4)), replace=False):
            w[k] = f"n{i}_{k}"
        rows.append((i, " ".join(w), "en", "a"))
    block, wide, jaccard.BLOCK, jaccard.WIDE = jaccard.BLOCK, jaccard.WIDE, 16, 64
    try:
        got = {r["doc_id"]: r["component_id"] for r in jaccard.ngram_jaccard_join(docs(spark, rows), 3, 90).collect()}
    finally:
        jaccard.BLOCK, jaccard.WIDE = block, wide
    assert got == components({i: shingles(t, 3) for i, t, *_ in rows}, 90)


@pytest.mark.parametrize("table", ["odd", "given"])
def test_substring(spark, table):
    df = docs(spark) if table == "odd" else given(spark, "documents")
    plain = {i: words(t) for i, t in texts(df).items()}
    first = {}
    for i in sorted(plain, reverse=True):
        for k in range(len(plain[i]) - 12):
            first[tuple(plain[i][k : k + 13])] = i
    want = {}
    for i, w in plain.items():
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        want[i] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    got = substring.substring_dedup(df, 13, digest=True).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want
    kept = substring.substring_dedup(df, 13)
    assert set(df.columns) <= set(kept.columns)
    assert all(len(words(r["text"])) == r["n_words"] - r["n_removed"] for r in kept.collect())


def test_substring_passage_in_many_contexts(spark):
    """A passage between words of each document's own: no automaton holds the pieces of all of them."""
    passage = " ".join(f"p{k}" for k in range(15))
    rows = [(k, " ".join([*(f"a{k}x{i}" for i in range(12)), passage, *(f"b{k % 1500}x{i}" for i in range(12))]), "en", "a") for k in range(2 * 2_100)]
    df = docs(spark, rows)
    assert substring.large_shards(substring._pieces_of(df.select("doc_id", "text"), 13)).count() > 0
    got = {r["doc_id"]: r["text"] for r in substring.substring_dedup(df).collect()}
    seen, want = set(), {}
    for i, t, *_ in rows:
        w = t.split()
        windows = [tuple(w[k : k + 13]) for k in range(len(w) - 12)]
        gone = {k + j for k, x in enumerate(windows) if x in seen for j in range(13)}
        seen.update(windows)
        want[i] = " ".join(x for k, x in enumerate(w) if k not in gone)
    assert got == want


@pytest.mark.parametrize("table", ["odd", "given"])
def test_packing(spark, table):
    df = docs(spark) if table == "odd" else given(spark, "documents")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for i, t in texts(df).items()}
    rows = packing.pack(df, *queries.TOKENIZER).collect()
    bins, covered = collections.defaultdict(list), collections.Counter()
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        if r["doc_id"] is not None:
            part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
            assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
            covered[r["doc_id"]] += r["length"]
    copies = collections.Counter(r["doc_id"] for r in df.collect())
    assert covered == {i: copies[i] * len(x) for i, x in ids.items()}
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024 and not at & (at - 1)


@pytest.mark.parametrize("table", ["odd", "given"])
def test_mixing(spark, table):
    df = docs(spark) if table == "odd" else given(spark, "documents")
    rows = mixing.mixture_report(df).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mixture_report(df).collect()), key=str)
    assert len(rows) == df.count() and all(r["taken"] <= 3 * r["size"] for r in rows)
    sizes = collections.Counter()
    for r in df.collect():
        sizes[r["source"]] += len(words(r["text"]))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, mixing.targets([sizes[s] for s in names], [1.0 + k % 3 for k in range(len(names))])))
    target = collections.defaultdict(set)
    taken = collections.Counter()
    for r, d in zip(sorted(rows, key=lambda r: (str(r["doc_id"]), r["size"])), sorted(df.collect(), key=lambda d: (str(d["doc_id"]), len(words(d["text"]))))):
        target[d["source"]].add(r["target"])
        taken[d["source"]] += r["taken"]
    assert target == {s: {t} for s, t in want.items()}
    assert all(abs(taken[s] - want[s]) <= max(1, sizes[s] / 4096) for s in names)
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns and sum(len(words(r["text"])) for r in mixed.collect()) == sum(taken.values())


def test_harmonic_bins():
    """Bins of every class are full, few remainders are cut, and all ids come out once."""
    rng, bins, out = np.random.default_rng(6), packing.Bins(3, 1024), []
    sizes = [int(x) for x in rng.integers(1, 3000, 4000)]
    for k, n in enumerate(sizes):
        out += bins.put((k, 0, np.arange(n, dtype="<u4"), n))
    full = len(out)
    out += bins.rest()
    seen, lengths = collections.defaultdict(list), collections.Counter()
    for doc, start, ids, tokens, at, offset in out:
        assert ids.tolist() == list(range(start, start + len(ids))) and tokens == sizes[doc] and offset == lengths[at]
        seen[doc] += ids.tolist()
        lengths[at] += len(ids)
    assert {d: sorted(x) for d, x in seen.items()} == {d: list(range(n)) for d, n in enumerate(sizes)}
    assert sum(n == 1024 for n in lengths.values()) >= len(lengths) - 11 and all(not n & (n - 1) for n in lengths.values())
    assert full <= sum(n // 1024 for n in sizes) + 2.5 * len(sizes)


def test_pipeline_rules_learn_from_all_documents(spark, tmp_path):
    n = 21_000
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", k), F.lit(1000) + F.pow(10, F.col("id") % 7).cast("long")))), " ")
    text = F.concat(text, F.repeat(F.lit(" #|"), F.when(F.col("id") % 12 == 0, F.col("id") % 31).otherwise(F.pmod(F.xxhash64("id"), F.col("id") % 14 + 1)).cast("int")))
    frame = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"), F.lit(0).cast("long").alias("n_chars"))
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 12 == 0, 0).otherwise(1).alias("quality")).write.parquet(str(tmp_path / "labels.parquet"))
    documents = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"] for r in corpus_pipeline.rules(spark, documents, str(tmp_path)).select("doc_id").collect()}
    rows = isolation.statistics(documents).where("NOT base_failed").toPandas()
    x = isolation.features(rows)
    score = isolation.anomaly(isolation.fit_forest(x), x)
    threshold = isolation.calibrate(score, rows["doc_id"].to_numpy() % 12 != 0)
    assert got == set(rows["doc_id"][score <= threshold]) and 0 < len(got) < len(rows) and len(rows) > 20_000


def test_quota_tree():
    got = mixing.split_quotas([100, 7, 0, 3000], 8, 1)
    assert got.sum(axis=0).tolist() == [100, 7, 0, 3000] and max(got.sum(axis=1)) - min(got.sum(axis=1)) <= 1 and (got >= 0).all()


@pytest.mark.parametrize("table", ["odd", "given"])
def test_rules(spark, table):
    df = docs(spark) if table == "odd" else given(spark, "documents")
    got = isolation.quality_rules(df, given(spark, "labels")).collect()
    plain = texts(df)
    for r in got:
        t, w = plain[r["doc_id"]] or "", words(plain[r["doc_id"]])
        seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeated = {i + j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated))
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (len(w) < 50 or 100 * len(repeated) > 50 * len(w)) and not (r["base_failed"] and r["kept"])
    if table == "given":
        marked = {r["doc_id"]: r["quality"] for r in given(spark, "labels").collect()}
        good = [r["kept"] for r in got if marked.get(r["doc_id"]) == 1 and not r["base_failed"]]
        assert sum(good) >= 0.95 * len(good)


def test_discriminant(spark):
    got = quality_qda.quality_scores(given(spark, "documents"), given(spark, "labels")).collect()
    marked = {r["doc_id"]: r["quality"] for r in given(spark, "labels").collect()}
    held = [r for r in got if r["doc_id"] in marked and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["predicted"] == marked[r["doc_id"]] for r in held) >= 0.85 * len(held)
    assert {r["score"] for r in quality_qda.quality_scores(docs(spark), given(spark, "labels").limit(0)).collect()} == {0.5}
    assert quality_qda.quality_scores(docs(spark), given(spark, "labels")).count() == 14


@pytest.mark.parametrize("table", ["odd", "given"])
def test_lm_scores(spark, table):
    df = docs(spark) if table == "odd" else given(spark, "documents")
    target = given(spark, "benchmark")
    pairs = [collections.Counter(), collections.Counter()]
    vocabulary = set()
    for side, rows in ((0, target.collect()), (1, df.collect())):
        for r in rows:
            w = words(r["text"])
            vocabulary |= set(w)
            pairs[side].update(zip(w, w[1:]))
    first = [collections.Counter(), collections.Counter()]
    for side in (0, 1):
        for (v, _), n in pairs[side].items():
            first[side][v] += n

    def log_p(side, v, w):
        return np.log((pairs[side][v, w] + 0.01) / (first[side][v] + 0.01 * len(vocabulary)))

    got = {r["doc_id"]: r for r in lm_scoring.cross_entropy_difference(df, target).collect()}
    assert set(got) == set(texts(df))
    for i, t in texts(df).items():
        w = words(t)
        copies = sum(r["doc_id"] == i for r in df.collect())
        assert got[i]["n_tokens"] == copies * max(len(w) - 1, 0)
        want = np.mean([log_p(0, a, b) - log_p(1, a, b) for a, b in zip(w, w[1:])]) if len(w) > 1 else 0
        assert abs(got[i]["score"] - want) < 1e-9


def test_licenses(spark):
    text = "Copyright (c) 2020 Someone\n\n" + licenses.MIT.replace("license", "licence").upper().replace(",", " ,\n")
    got = {r["doc_id"]: r for r in licenses.license_scan(docs(spark, [(1, text, "", ""), (2, licenses.ISC, "", ""), (3, licenses.MIT + " and more", "", ""), (4, None, "", ""), (5, "prose\nReleased under the MIT Licence!", "", "")])).collect()}
    assert [got[i]["license"] for i in range(1, 6)] == ["MIT", "ISC", None, None, None]
    assert got[5]["notices"] == "MIT" and got[4]["digest"] is None and got[3]["n_notices"] == 0


def test_license_lines_of_any_length(spark):
    lines = [" ".join(licenses.MIT.split()), "=" * 1500 + " Released under the MIT License. " + " " * 1500]
    got = licenses.license_scan(docs(spark, [(k, "prose\n" + line, "", "") for k, line in enumerate(lines)])).collect()
    assert [(r["n_notices"], r["notices"]) for r in got] == [(1, "MIT")] * 2


def test_license_notices_without_the_word(spark):
    rows = [(1, "prose\nUnder the WTFPL.\nmore", "", ""), (2, " ".join(licenses.ISC.split()), "", ""), (3, "x\nReleased under the MIT License." + " " * 5000, "", "")]
    got = {r["doc_id"]: (r["n_notices"], r["notices"]) for r in licenses.license_scan(docs(spark, rows), (*licenses.KNOWN_TEXTS, ("WTFPL", "Under the WTFPL."))).collect()}
    assert got == {1: (1, "WTFPL"), 2: (1, "ISC"), 3: (1, "MIT")}


def page(nav, body):
    return f"<html><head><title>t</title><script>x<1</script></head><body><nav><a>{nav}</a></nav><div class='top'>Same on all</div><article><header><h1>Head</h1></header><p>{body}<p>Two &amp; <b>bold</b>\n x<br>new</article><div class='comments'>hi</div><footer>f</footer></body></html>"


def test_html(spark):
    rows = [(k, f"http://h.example/{k}", page(k, f"body {k}")) for k in range(6)]
    bare = [(10 + k, "HTTP://b.example/x", f"<div><div class=x>Same words</div><div class=y>Own {k}</div></div>") for k in range(4)]
    odd = [(20, None, None), (21, "", ""), (22, "::", "plain &lt; text <p"), (23, "u", "<div>" * 3000 + "deep"), (None, "u", "<p>a</p>")]
    got = {r["page_id"]: r["text"] for r in html_tree.extract_main_text(spark.createDataFrame(rows + bare + odd, "page_id long, url string, html string")).collect()}
    assert got[3] == "Head\nbody 3\nTwo & bold x\nnew"
    assert got[11] == "Own 1" and got[20] == got[21] == "" and got[22].startswith("plain < text") and got[23] == "deep" and got[None] == "a"


TEXT = "The text of this page goes on for a while."


NAMED_PAGES = [
    (f"<body><article><header class='entry-header'><h1>Title</h1></header><p>{TEXT}</p></article></body>", f"Title\n{TEXT}"),
    (f"<body><div class='layout no-sidebar'><p>{TEXT}</p></div><div class='sidebar'>Ad</div></body>", TEXT),
    (f"<body><div id='page' class='has-sidebar'><p>{TEXT}</p><div class='site-footer'>Foot</div></div></body>", TEXT),
    (f"<body><form id='login'><div class='side-by-side'><p>{TEXT}</p></div><nav>Menu</nav></form></body>", TEXT),
    (f"<body><div class='banner'><article><p>{TEXT}</p></article></div><p>{TEXT}</p></body>", TEXT),
    (f"<body><main><p>{TEXT}</p></main><article>Card</article></body>", TEXT),
    (f"<body><main><p>{TEXT}</p><article>Card</article></main></body>", f"{TEXT}\nCard"),
    (f"<body><p>{TEXT}</p><div class='comments-area'>Hi</div><div class='ad-1 x'>Buy</div><div class='main-nav'>Go</div></body>", TEXT),
]


def test_html_names(spark):
    """Pages alone on their host: what their markup names decides."""
    rows = [(k, f"http://h{k}.example/", html) for k, (html, _) in enumerate(NAMED_PAGES)]
    got = {r["page_id"]: r["text"] for r in html_tree.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: want for k, (_, want) in enumerate(NAMED_PAGES)}


def plain_tree(pages):
    """The keys that go, of the pages of one host as nested lists (name, children): the rule written out over the whole tree at once."""
    at = collections.defaultdict(list)

    def walk(path, node, page):
        at[path].append((page, node))
        for c in node[1]:
            if not isinstance(c, str):
                walk(path + (c[0],), c, page)

    for k, page in enumerate(pages):
        walk((page[0],), page, k)
    m = {p: len({k for k, _ in found}) for p, found in at.items()}
    own, loss, varied, mass = {}, {}, {}, {}
    for p, found in at.items():
        texts = collections.Counter()
        for k in {k for k, _ in found}:
            texts.update({c for kk, n in found if kk == k for c in n[1] if isinstance(c, str)})
        styles = collections.Counter(tuple(c[0] for c in n[1] if not isinstance(c, str)) for _, n in found)
        own[p] = sum(len(c.replace(" ", "")) for _, n in found for c in n[1] if isinstance(c, str))
        many, s = m[p] >= 3, sum(styles.values())
        loss[p] = (sum(texts.values()), sum(n * np.log(n) for n in texts.values()) / np.log(m[p]) if many and p[-1] != "h1" else 0)
        varied[p] = sum(-n / s * np.log(n / s) for n in styles.values()) / np.log(s) if many else 0
    noise = {}
    for p in at:
        below = [q for q in at if q[: len(p)] == p]
        total, lost = (sum(loss[q][i] for q in below) for i in (0, 1))
        mass[p] = sum(own[q] for q in below)
        noise[p] = 0 if p[-1] == "h1" or not total else lost / total * (1 - max(varied[q] for q in below))
    gone = set()
    for p in at:
        if len(p) > 1:
            beside = [q for q in at if q[:-1] == p[:-1]]
            best = max(beside, key=lambda q: (mass[q] * max(1 - noise[q], 0), mass[q]))
            base = 0 if own[p[:-1]] > mass[best] * max(1 - noise[best], 0) else noise[best]
            if noise[p] > 0.05 + 1.5 * base:
                gone.add(p)
    return gone


def test_html_tree(spark):
    """Pages whose markup names nothing, against the rule written out: repeated blocks in several places, in two hosts of different templates."""
    rng, pages = np.random.default_rng(2), {}
    for host in range(2):
        made = []
        for k in range(24):
            text = [("p", [f"words {host} {k} {j} {rng.integers(10**6)}"]) for j in range(rng.integers(1, 6))]
            menu = ("div", [("table", [("tr", [f"entry {rng.integers(5)}"]) for _ in range(3)])])
            side = ("section", [("blockquote", [f"buy {rng.integers(4)}"]), ("pre", [f"item {k}"])][: 2 - host])
            made.append(("body", [menu, ("center", [("h1", ["Same title"]), *text]), side, ("address", ["All rights reserved"])]))
        pages[host] = made

    def html(node):
        return f"<{node[0]}>" + "".join(c if isinstance(c, str) else html(c) for c in node[1]) + f"</{node[0]}>"

    def kept(path, node, gone):
        return [x for c in node[1] for x in ([c] if isinstance(c, str) else [] if path + (c[0],) in gone else kept(path + (c[0],), c, gone))]

    rows = [(100 * h + k, f"http://{h}.example/{k}", html(p)) for h, made in pages.items() for k, p in enumerate(made)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "page_id long, url string, html string, n int, mass string")
    got = {r["page_id"]: r["text"] for r in html_tree.extract_main_text(df).collect()}
    want = {}
    for h, made in pages.items():
        gone = plain_tree(made)
        assert gone
        want |= {100 * h + k: "\n".join(kept(("body",), p, gone)) for k, p in enumerate(made)}
    assert got == want and "Same title" in got[0] and "rights" not in got[0] and "entry" not in got[0]
    twice = html_tree.extract_main_text(df.unionByName(df)).collect()
    assert len(twice) == 2 * len(rows)


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(700, 16))
    base[100:140] = base[0]
    rows = [(k, v.tolist()) for k, v in enumerate(base)] + [(900, None), (1000, [0.0] * 16), (1100, [float("nan")] * 16), (1200, [1.0, None] * 8), (1300, [1.0]), (None, base[0].tolist())]
    got = collections.defaultdict(list)
    for r in ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    assert set(got) == set(range(0, 700, 100))
    hit = 0
    for q, found in got.items():
        want = sorted((float(np.sqrt(((base[k] - base[q]) ** 2).sum())), k) for k in range(700) if k != q)[:10]
        assert len(found) == 10 and found == sorted(found)
        hit += len({k for _, k in want} & {k for _, k in found})
    assert hit >= 63 and got[0] == [(0.0, k) for k in range(100, 110)]
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in ann.nearest_neighbours(few).collect()] and ann.nearest_neighbours(few.limit(0)).count() == 0


def test_neighbours_of_many_cells(spark, monkeypatch):
    """Where the first two of 512 cells hold few of the neighbours, more are probed; split cells give the same rows."""
    base = np.random.default_rng(5).normal(size=(20_000, 64))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(base)], "vec_id long, embedding array<double>").repartition(4)
    found = lambda: {(r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest_neighbours(df, every=400, probes=2).collect()}
    got, hit = found(), 0
    for q in range(0, 20_000, 400):
        apart = ((base - base[q]) ** 2).sum(axis=1)
        apart[q] = np.inf
        hit += len(set(np.argsort(apart)[:10].tolist()) & {v for i, _, v in got if i == q})
    assert len(got) == 500 and hit >= 450
    monkeypatch.setattr(ann, "MEMBERS", 30)
    monkeypatch.setattr(ann, "QUERIES", 3)
    assert found() == got


def test_empty_tables(spark):
    none, labels = docs(spark).limit(0), given(spark, "labels").limit(0)
    assert jaccard.ngram_jaccard_join(none).count() == substring.substring_dedup(none).count() == packing.pack(none, *queries.TOKENIZER).count() == 0
    assert mixing.mixture_report(none).count() == isolation.quality_rules(none, labels).count() == quality_qda.quality_scores(none, labels).count() == 0
    assert licenses.license_scan(none).count() == lm_scoring.cross_entropy_difference(none, none).count() == 0
    assert html_tree.extract_main_text(given(spark, "pages").limit(0)).count() == 0


def test_pipeline(spark):
    docs_, plain = given(spark, "documents"), texts(given(spark, "documents"))
    kept = docs_
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, FOLDER)
        assert tuple(kept.columns) == corpus_pipeline.COLUMNS, name
    left = texts(kept)
    assert set(left) <= set(plain) and len(left) >= 0.5 * len(plain)
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} <= set(left) and min(r["length"] for r in rows) >= 1


def test_stages_take_hostile_rows(spark):
    """Null, empty, repeated, tied and very long rows, and columns of clashing names, through every stage."""
    given_docs = docs(spark).drop("n_words", "label")
    huge = "".join(f"u{k} " for k in range(200_000))
    extra = spark.createDataFrame([(50, huge, "en", "a", 0), (51, huge + "tail", "en", "b", 0), (10, BASE + " other text of id ten", "en", "a", 0)], given_docs.schema)
    kept = given_docs.unionByName(extra)
    for name, stage in corpus_pipeline.STAGES[1:4]:
        for table in (kept, kept.limit(0)):
            out = stage(spark, table, FOLDER)
            assert tuple(out.columns) == corpus_pipeline.COLUMNS, name
            rows = out.collect()
            assert table is kept or not rows, name
            if table is kept:
                by_id = collections.Counter(r["doc_id"] for r in rows)
                if name == "n-gram Jaccard join":
                    # Of equal texts the smallest id stays; an id with two texts gives one row.
                    assert None not in by_id and max(by_id.values()) == 1 and 2 not in by_id and 51 not in by_id and {1, 4, 5, 6, 50} <= set(by_id)
                if name == "substring dedup":
                    left = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] not in (10, None)}
                    assert left[1] == BASE and 2 not in left and left[51].strip() == "tail" and len(left[50]) == len(huge)
                if name == "mixing sources":
                    assert rows and all(r["text"].split() for r in rows)
    packed = corpus_pipeline.STAGES[4][1](spark, kept, FOLDER).collect()
    assert sum(r["length"] for r in packed if r["doc_id"] == 4) == 1 and sum(r["length"] for r in packed if r["doc_id"] == 50) > 400_000


def test_discriminant_is_the_difference_of_gaussian_densities():
    """margin() by factors against densities written out, in the data's own units."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4)) * np.array([1.0, 10.0, 0.1, 1.0])
    y = (np.arange(200) % 3 == 0).astype(int)
    x[y == 1] += 0.5
    parts = {c: x[y == c] for c in (0, 1)}
    model = quality_qda.discriminant({c: (float(len(p)), p.sum(axis=0), p.T @ p) for c, p in parts.items()})
    spread = {c: (p - p.mean(axis=0)).T @ (p - p.mean(axis=0)) for c, p in parts.items()}
    pooled = (spread[0] + spread[1]) / (len(x) - 2)
    units = np.outer(np.sqrt(np.diag(pooled)), np.sqrt(np.diag(pooled)))

    def log_density(row, c):
        mixed = (1 - quality_qda.POOL) * spread[c] / (len(parts[c]) - 1) + quality_qda.POOL * pooled
        ridge = np.trace(mixed / units) / 4
        cov = (1 - quality_qda.RIDGE) * mixed + quality_qda.RIDGE * ridge * np.diag(np.diag(pooled))
        d = row - parts[c].mean(axis=0)
        return np.log(len(parts[c]) / len(x)) - 0.5 * (d @ np.linalg.inv(cov) @ d + np.linalg.slogdet(cov)[1])

    assert np.allclose(quality_qda.margin(model, x), [log_density(r, 1) - log_density(r, 0) for r in x])


def test_quality_scores_rank_held_out_rows_that_labels_never_reach(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")  # noqa: E731 (some 70 held-out labels; the smallest table has 3 bad ones)
    scored = quality_qda.quality_scores(read("documents"), read("labels"))
    known = {r["doc_id"]: r["quality"] for r in read("labels").collect()}
    rows = scored.collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(r["score"], known[r["doc_id"]]) for r in rows if r["held_out"] and known.get(r["doc_id"]) in (0, 1)]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert good and bad and np.mean([[g > b for b in bad] for g in good]) > 0.9
    # Other labels of held-out rows change no score.
    flipped = read("labels").withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality_qda.quality_scores(read("documents"), flipped).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in rows)


def test_all_labelled_rows_scale_the_scores(spark):
    """More labelled rows than any bounded sample had: over all of them the likelihood of the scores is at its top."""
    hashed = F.pmod(F.xxhash64("id"), F.lit(10)).cast("int")
    text = F.concat_ws(" ", F.repeat(F.lit("Word some, "), F.pmod(F.col("id"), F.lit(4)).cast("int") + 1), F.repeat(F.lit("#! "), F.when(hashed < 4, F.col("id") % 5).otherwise(0).cast("int")), hashed)
    documents = spark.range(66_000).select(F.col("id").alias("doc_id"), text.alias("text"))
    labels = spark.range(66_000).select(F.col("id").alias("doc_id"), (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(100)) < F.when(hashed < 4, 30).otherwise(70)).cast("int").alias("quality"))
    rows = isolation.statistics(documents).join(quality_qda.quality_scores(documents, labels), "doc_id").join(labels, "doc_id").where("NOT held_out").toPandas()
    x, y, p = quality_qda.transformed(rows), rows["quality"].to_numpy(), rows["score"].to_numpy()
    parts = {c: x[y == c] for c in (0, 1)}
    model = quality_qda.discriminant({c: (float(len(v)), v.sum(axis=0), v.T @ v) for c, v in parts.items()})
    z = quality_qda.squash(quality_qda.margin(model, x))
    slope, level = np.polyfit(z, np.log(p / (1 - p)), 1)
    assert len(rows) > 50_000 and np.allclose(np.log(p / (1 - p)), slope * z + level)
    assert abs(((p - y) * z).sum() + 1e-3 * slope) < 1e-3 and abs((p - y).sum() + 1e-3 * level) < 1e-3


def test_anomaly_is_the_recursive_path_length():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5))
    model = isolation.fit_forest(x, seed=3)

    def path(tree, row, node=0):
        feature, cut, left = tree
        return cut[node] if feature[node] < 0 else path(tree, row, left[node] + (row[feature[node]] >= cut[node]))

    want = [2 ** (-np.mean([path(t, row) for t in model["trees"]]) / model["norm"]) for row in x[:60]]
    assert np.allclose(isolation.anomaly(model, x[:60]), want)
    far = np.full((1, 5), 50.0)
    assert isolation.anomaly(model, far)[0] > max(isolation.anomaly(model, x)) - 1e-9


def test_forest_and_threshold_are_of_all_rows(spark):
    """More rows than any bounded sample had, in partitions of any size, some of them empty."""
    rows = spark.range(21_000).select(
        F.col("id").alias("doc_id"),
        (50 + F.col("id") % 97).alias("n_words"),
        (300 + F.col("id") % 211).alias("word_chars"),
        (F.pmod(F.xxhash64("id"), F.lit(7)) + F.when(F.col("id") == 20_001, 40).otherwise(0)).alias("n_symbols"),
        (F.col("id") % 3).alias("n_marks"),
        (F.col("id") % 90).alias("n_upper"),
        *[F.lit(0).cast("long").alias(c) for c in ("n_dup_lines", "n_repeat_words", "n_distinct")],
        (F.col("id") % 50 == 0).alias("base_failed"),
    )
    labels = rows.select("doc_id", F.when(F.col("n_symbols") > 4, 0).otherwise(1).alias("quality"))
    text, threshold = isolation.fitted(rows.repartition(5).union(rows.limit(0)), labels)
    frame = rows.where("NOT base_failed").toPandas()
    x = isolation.features(frame)
    whole = isolation.fit_forest(x)
    assert json.loads(text) == whole
    assert threshold == isolation.calibrate(isolation.anomaly(whole, x), frame["n_symbols"].to_numpy() <= 4) < 1


def test_a_page_is_read_in_few_calls():
    """The cost of a page as Python calls, which do not vary: its tags are read at once, and nodes of one path tell it once."""
    page = "<html><body><div><nav><ul>" + "<li>menu</li>" * 20 + "</ul></nav><article>" + "<p>Some <b>text</b> here.</p>" * 100 + "</article></div></body></html>"
    calls = collections.Counter()

    def count(frame, event, arg):
        calls[event] += 1

    for read in (html_tree.page_nodes, lambda html: html_tree.main_text(html, set())):
        sys.setprofile(count)
        try:
            read(page)
        finally:
            sys.setprofile(None)
    assert calls["call"] < 12_000


def test_threshold_is_brute_force():
    rng = np.random.default_rng(2)
    score, good = np.round(rng.random(80), 2), rng.random(80) < 0.7
    at = isolation.calibrate(score, good)
    gain = lambda t: (score[~good] > t).mean() - isolation.COST * (score[good] > t).mean()
    assert abs(gain(at) - max(0, max(gain(t) for t in np.r_[score - 1e-6, score, 1.0]))) < 1e-9
    assert isolation.calibrate(score, np.ones(80, bool)) == 1.0


def test_targets_are_brute_force():
    """Water filling by small steps: each source takes by weight until it is full."""
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = [int(s) for s in rng.integers(1, 1000, size=rng.integers(1, 9))]
        weights = [(1.0, 2.0, 3.0)[k % 3] for k in range(len(sizes))]
        # The level at which sum(min(3 size, weight * level)) is all words, by bisection.
        low, high = 0.0, 1e7
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if sum(min(3 * s, w * middle) for s, w in zip(sizes, weights)) < sum(sizes) else (low, middle)
        assert np.allclose(mixing.targets(sizes, weights), [min(3 * s, w * high) for s, w in zip(sizes, weights)], rtol=1e-6)


@pytest.mark.parametrize("few", [0, 200_000])
def test_components_by_rounds_and_in_one_task(spark, monkeypatch, few):
    from brindle.llm import components as module

    monkeypatch.setattr(module, "FEW", few)
    rng = np.random.default_rng(few)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, size=(45, 2))] + [(100 + k, 101 + k) for k in range(6)] + [(7, 7)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    frame = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in module.components(frame).collect()}
    assert got == {x: root[x] for e in edges if e[0] != e[1] for x in e}
    assert module.components(frame.limit(0)).count() == 0


def test_kept_documents_are_those_of_quality_rules(spark):
    documents, labels = given(spark, "documents"), given(spark, "labels")
    judged = {r["doc_id"] for r in isolation.quality_rules(documents, labels).where("kept").collect()}
    assert {r["doc_id"] for r in isolation.kept_documents(documents, labels).collect()} == judged
    odd = isolation.kept_documents(docs(spark), labels)
    assert odd.columns == docs(spark).columns and sorted(r["doc_id"] for r in odd.collect() if r["doc_id"] in (1, 2)) == [1, 2]
    assert isolation.kept_documents(docs(spark).limit(0), labels).count() == 0
