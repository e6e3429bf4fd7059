import __spark_entry__ as entry
import check_oracle
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query_equals_sql(spark, con, name):
    rows, verdict = check_oracle.compare(spark, con, SF_DIR, name)
    assert rows > 0
    assert verdict == "ok"


def test_every_sql_has_a_query():
    assert set(entry.ORACLE) <= set(entry.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["name", "number_of_events"]
