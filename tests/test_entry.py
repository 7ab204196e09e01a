import os
import sys

import duckdb

import __spark_entry__ as E
from orrery.sources.tables import TABLES
from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from oracle_check import _rows  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["series_key", "rate", "samples"]


OWN = E._catalog.queries()


def test_every_query_has_oracle():
    assert set(OWN) <= set(E.oracle_sql())


def test_queries_match_oracle_small(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    bad = []
    for name, fn in ((k, f) for k, f in E.queries().items() if k in OWN):
        s = _rows(fn(spark, SF_SMALL).toPandas())
        o = _rows(con.execute(E.oracle_sql()[name]).df())
        if s != o:
            bad.append(name)
    assert bad == []
