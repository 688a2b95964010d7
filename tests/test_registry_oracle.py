"""Every registered query with a SQL twin equals DuckDB at sf0.001 (the
driver runs the same comparison at sf0.01; see tests/oracle_check.py)."""

import pytest

import __spark_entry__ as E
from tablework.plans import registry
from conftest import SF001
from oracle_check import duck, fingerprint

KEYS = sorted(registry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", KEYS)
def test_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    assert len({c.lower() for c in sdf.columns}) == len(sdf.columns)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    sc, sh, _ = fingerprint(sdf.columns, srows)
    dc, dh, _ = fingerprint([d[0] for d in cur.description], drows)
    assert len(srows) == len(drows)
    assert sc == dc
    assert sh == dh


def test_every_key_has_a_twin(spark):
    assert set(registry.queries()) - set(KEYS) == {"csv_inferred_scan"} - set(KEYS)
    for name in set(registry.queries()) - set(KEYS):
        out = E.queries()[name](spark, SF001)
        assert out.count() > 0 and len({c.lower() for c in out.columns}) == len(out.columns)
