import duckdb
import pytest

from claimloom import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_same_rows_as_sql(spark, duck, name):
    own = catalogue.queries()[name](spark, SF)
    columns = sorted(own.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in own.collect()), key=str)
    found = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in found.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=str)
    assert sorted(names) == columns and rows == want


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_others_give_a_row_for_each_page(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
