import __spark_entry__ as entry


def test_every_check_is_sql():
    sql = entry.oracle_sql()
    assert sql and all(isinstance(text, str) for text in sql.values())
    assert sql.keys() <= entry.queries().keys()
