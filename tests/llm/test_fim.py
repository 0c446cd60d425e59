"""Fill-in-the-middle against whole-text brute force."""

import hashlib

import duckdb
import pytest

from brindle.llm import fim, queries

ROWS = [(0, "abc" * 9), (1, "é🙂\x00ß" * 50), (2, None), (3, ""), (4, "has <S> in it"), (5, "x"), (5, "x"), (5, "another text of the same id"), (None, "no id"), (2**53 + 1, "large id"), (6, "<" * 40 + "P>" * 40), *[(k, f"text {k} " * (k % 7 + 1)) for k in range(10, 200)]]


def docs(spark, rows=ROWS):
    made = [(i, t, "clash", "clash", 1, b"x") for i, t in rows]
    return spark.createDataFrame(made, "doc_id long, text string, form string, digest string, at int, n binary")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def want(i, text):
    t = text or ""
    n, h = len(t), hashlib.sha256(f"1:{i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if i is None or not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (i, n, "plain", None, None, sha(t), sha(t)), t
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}" if form == "spm" else f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"
    return (i, n, form, a, b - a, sha(out), sha(t)), out


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("chunk", [1, 7, fim.CHUNK])
def test_report_is_brute_force(spark, chunk):
    got = fim.fim_report(docs(spark), seed=1, chunk=chunk)
    assert plain(got.collect()) == plain(want(i, t)[0] for i, t in ROWS)


def test_forms_all_occur_and_texts_are_outputs(spark):
    got = fim.fim_texts(docs(spark), seed=1, chunk=5)
    assert plain((r["doc_id"], r["form"], r["output"]) for r in got.collect()) == plain((i, want(i, t)[0][2], want(i, t)[1]) for i, t in ROWS)
    assert {r["form"] for r in got.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_very_long_text_and_empty_table(spark):
    long = "word é " * 3_000_000
    got = fim.fim_report(docs(spark, [(7, long), (8, "short")]), seed=1).collect()
    assert plain(got) == plain([want(7, long)[0], want(8, "short")[0]])
    assert fim.fim_report(docs(spark, []), seed=1).count() == 0


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    found = con.execute(queries.ORACLE_SQL["op12_fill_in_middle"])
    columns = [d[0] for d in found.description]
    assert plain(queries.QUERIES["op12_fill_in_middle"](spark, folder).select(*columns).collect()) == plain(found.fetchall())
