"""Every registered query against its DuckDB oracle on the smallest driver scale."""

import os
import sys

import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import canon  # noqa: E402

from dimforge.plans import load_all  # noqa: E402

REG = load_all()


@pytest.mark.parametrize("key", sorted(REG))
def test_query_matches_oracle(spark, duck, key):
    fn, sql = REG[key]
    df = fn(spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        assert df.columns
        return
    res = duck.execute(sql)
    dcols = [d[0] for d in res.description]
    sc, sr = canon(df.columns, rows)
    dc, dr = canon(dcols, res.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
