"""The driver contract in __spark_entry__.py."""
from chartlake.plans import registry
import __spark_entry__ as E


def test_entry_runs_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["source", "duration", "popularity", "track_id", "artist_id", "name",
                          "release_date", "chart_date"]
    assert df.count() > 0


def test_queries_and_oracles_pair_up():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 50
    assert set(registry.QUERIES) == set(registry.QUERIES) & set(sql)  # these all have SQL
    for name, fn in qs.items():
        assert callable(fn) and fn.__name__ == name
