import duckdb
import pytest

import __spark_entry__
from brindle.plans.catalog import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows):
    number = lambda v: v if v is None or isinstance(v, str) else float(v)
    return sorted((tuple(number(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_rows_equal_sql(spark, db, name):
    got = QUERIES[name](spark, FOLDER)
    found = db.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(got.columns)
    assert plain(got.select(*[f"`{c}`" for c in columns]).collect()) == plain(found.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0 and set(QUERIES) <= set(__spark_entry__.queries())
