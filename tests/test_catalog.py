"""Every registered core query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

from tapelake.plans import catalog, fields, jobs, loads

assert fields and jobs and loads  # they register their queries

DATA = "/root/testdata/sf0.001"


def rows(frame):
    return sorted(tuple("" if v is None or v != v else repr(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False, name=None))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_twin(spark, name):
    base = duckdb.connect()
    for file in os.listdir(DATA):
        base.execute(f"create view {file.split('.')[0]} as select * from '{DATA}/{file}'")
    assert rows(catalog.QUERIES[name](spark, DATA).toPandas()) == rows(base.execute(catalog.ORACLE_SQL[name]).df())
