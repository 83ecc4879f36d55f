"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""
import hashlib
import math

import duckdb
import pandas as pd
import pytest

from chartlake.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def _digest(df):
    cols = sorted(df.columns)
    rows = sorted("\x1f".join(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


def test_every_query_has_an_oracle():
    assert set(registry.ORACLE) == set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_oracle(spark, con, name):
    got = registry.run(spark, name, SF).toPandas()
    want = con.execute(registry.ORACLE[name]).df()
    assert _digest(got) == _digest(want)
