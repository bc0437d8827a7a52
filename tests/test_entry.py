"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as entry
import parity
from conftest import SF_SMALL


def test_entry_runs_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["rank", "n_posts", "avg_reputation"]
    assert df.count() > 0


def test_contract_keys():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50
    con = parity.duck(SF_SMALL)
    for key, sql in o.items():   # every oracle statement runs on DuckDB
        con.sql(sql).fetchall()
