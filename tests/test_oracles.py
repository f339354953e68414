"""Every registered query with an oracle equals its DuckDB SQL on sf0.001."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck, type_diff

from quarry.plans.registry import load_all

_REG = load_all()
_NAMES = sorted(n for n, q in _REG.items() if q.oracle)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", _NAMES)
def test_query_matches_oracle(spark, con, name):
    q = _REG[name]
    df = q.build(spark, SF_SMALL)
    srows = [r.asDict(recursive=True) for r in df.collect()]
    cur = con.execute(q.oracle)
    names = [d[0] for d in cur.description]
    # Rows as dicts would hide a column that is there twice.
    assert sorted(df.columns) == sorted(names)
    drows = [dict(zip(names, r)) for r in cur.fetchall()]
    assert compare(srows, drows) is None
    assert type_diff(df.schema, cur.description) is None


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
