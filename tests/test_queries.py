"""Every registered query against its independent SQL, on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"trend_threads", "gather_and_classify", "clean_articles"}))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert differences(df, con, SQL[name]) is None
    else:
        if name == "cluster_vectors":  # small groups are left out; the smallest tables have no group that is large enough
            df = QUERIES[name](spark, "/root/testdata/sf0.01")
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["sample", "rank", "word", "cnt", "kind", "label", "n", "percentage"]
    assert df.count() > 0
