def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 4                                  # FIXTURES §3, sf0.001 run 1
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50
    assert all(isinstance(v, str) and v.strip() for v in o.values())
