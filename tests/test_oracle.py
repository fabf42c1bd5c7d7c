"""Every registered key agrees with its DuckDB oracle on the smallest data."""
import pytest

from tidewater.plans.catalog import ORACLE, QUERIES, load_all
from tidewater.plans.verify import duck, rows_of

load_all()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert len(df.columns) > 0
        return
    cur = con.execute(ORACLE[key])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, rows) == rows_of(cols, cur.fetchall())
