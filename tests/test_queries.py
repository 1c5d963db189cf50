import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CORE = sorted(n for n in entry.queries() if not re.match(r"op\d+_", n) and n != "pipeline")


def plain(v):
    return round(v, 6) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", CORE)
def test_against_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got
    if name in entry.oracle_sql():
        db = duckdb.connect()
        for t in TABLES:
            db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
        result = db.execute(entry.oracle_sql()[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 8
