def test_entry_and_registry_contract(spark):
    import __spark_entry__ as ent

    df = ent.entry(spark)
    row = df.first()
    assert row.total_rows > 0 and row.passed_rows + row.failed_rows == row.total_rows
    qs, sql = ent.queries(), ent.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50


def test_every_query_plans_on_small_data(spark):
    """Each registered query analyses and returns its schema on sf0.001 (no full execution)."""
    import __spark_entry__ as ent
    from tests.conftest import SF_SMALL

    for name, fn in ent.queries().items():
        assert fn(spark, SF_SMALL).columns, name
