"""Alignment of two tokenizers against brute force over whole texts."""

import collections
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from brindle.llm import alignment, queries

FILES = (*queries.TOKENIZER, queries.PIECES)
ODD = [None, "", " ", "  ", "a", "a  b", " lead", "trail ", "a \n \n b", "x\n\n foo\n \nbar", "\tTab nbsp  b", "has ▁ in it", "<|endoftext|> and <s> </s> <unk> <0x41>", "é🙂 ßẞ \x00 ﬁ ½ ¨", "don't we'll 12345 a1b2", "ع مرحبا 你好 世界", "é ́x", "-" * 300, "word " * 500, "word\r\nline  two   three"]


def rows_of(texts):
    return [(k, t, 0, "clash", b"x") for k, t in enumerate(texts)]


def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), "doc_id long, text string, row int, a string, pairs binary")


@pytest.fixture(scope="module")
def whole():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[3])
    letters = {c: x for x, c in zip([*range(33, 127), *range(161, 173), *range(174, 256)], map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]))}
    k = 256
    for x in range(256):
        if x not in letters.values():
            letters[chr(k)] = x
            k += 1

    def tokens(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        spell_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        pieces = map(b.id_to_piece, ids_b)
        spell_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
        return ids_a, ids_b, spell_a, spell_b

    return tokens


def brute(text, whole):
    """(n_a, n_b, n_groups, links, groups) by the sets of end offsets and by intersecting byte ranges."""
    if not text:
        return 0, 0, 0, [], ""
    a, b, x, y = whole(text)
    raw = (" " + text).encode()
    if b"".join(x) != raw or b"".join(y) != raw:
        return 0, 0, 0, [], ""

    def ranges(parts):
        out, at = [], 0
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    ra, rb = ranges(x), ranges(y)
    links = [(i, j) for i, (s, e) in zip(a, ra) for j, (u, v) in zip(b, rb) if s < v and u < e]
    both = sorted({e for _, e in ra} & {e for _, e in rb})
    groups, start = [], 0
    for end in both:
        groups.append(",".join(str(i) for i, (s, e) in zip(a, ra) if start <= s and e <= end) + "|" + ",".join(str(i) for i, (s, e) in zip(b, rb) if start <= s and e <= end))
        start = end
    return len(a), len(b), len(both), links, ";".join(groups)


def report(texts, whole):
    found = [brute(t, whole) for t in texts]
    count = collections.Counter(p for _, _, _, links, _ in found for p in set(links))
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [
        (k, n_a, n_b, n, len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if links else "")
        for k, (n_a, n_b, n, links, groups) in enumerate(found)
    ]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 200, 0])
def test_report_is_brute_force(spark, whole, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    given = [r["text"][:600] if r["text"] else r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts = [*ODD, *given[:80], *given[:5]]
    got = alignment.alignment_report(docs(spark, texts), *FILES, size_b=32_000).collect()
    assert sorted(map(tuple, got)) == report(texts, whole)


def test_words_and_segments_do_not_change_tokens(whole, monkeypatch):
    both, names_a, names_b = alignment._tokenizers(*FILES)
    rng = random.Random(5)
    parts = ["a", "foo", "Bar's", " ", "  ", "\n", "\t", " ", "é", "é", "12", "...", "🙂", "\x1c", "　", "-"]
    for segment in (1, 5, 1 << 18):
        monkeypatch.setattr(alignment, "SEGMENT", segment)
        for _ in range(400):
            text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))
            n_a, n_b, n_groups, links, groups = brute(text, whole)
            got = alignment._aligned(text, both, names_a, names_b, True)
            assert (*got[:4], got[7]) == (n_a, n_b, n_groups, len(links), groups), repr(text)


def test_diagonals_skip_runs_and_update_the_shift():
    rng = random.Random(7)
    for _ in range(500):
        size = rng.randrange(1, 60)
        common = sorted(rng.sample(range(1, 200), size))
        more = lambda: sorted({*common, *rng.sample(range(1, common[-1] + 1), min(common[-1], rng.randrange(8)))})
        a, b = more(), more()
        straight, link_a, link_b, irregular = alignment.diagonals(a, b)
        cuts = []
        for i, j, n in straight.tolist():
            assert a[i : i + n] == b[j : j + n]
            cuts += a[i : i + n]
        for i, j in irregular.tolist():
            assert a[i] == b[j]
            cuts.append(a[i])
        assert sorted(cuts) == sorted(set(a) & set(b))
        one_a, one_b = (x.tolist() for x in alignment.straight_tokens(straight))
        begin = lambda ends, k: ends[k - 1] if k else 0
        want = [(k, m) for k in range(len(a)) for m in range(len(b)) if begin(a, k) < b[m] and begin(b, m) < a[k]]
        assert sorted(zip(one_a + link_a, one_b + link_b)) == want


def test_very_long_text_repeats_null_ids_and_empty_table(spark, whole):
    long = "Some words, and 12 more. " * 80_000
    made = spark.createDataFrame([(None, "a b"), (2**53 + 1, "a b"), (4, long), (4, long)], "doc_id long, text string")
    got = alignment.alignment_report(made, *FILES, size_b=32_000).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["4", "4", str(2**53 + 1), "None"]
    assert {r["n_links"] for r in got if r["doc_id"] is None or r["doc_id"] > 4} == {len(brute("a b", whole)[3])}
    assert len({tuple(r) for r in got if r["doc_id"] == 4}) == 1 and next(r for r in got if r["doc_id"] == 4)["n_a"] > 400_000
    assert alignment.alignment_report(made.limit(0), *FILES, size_b=32_000).count() == 0
