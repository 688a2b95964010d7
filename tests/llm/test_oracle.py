"""Every query of the subpackage: unique column names, rows equal to its SQL
twin where there is one."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_check import duck, fingerprint
from tablework.llm import queries

NAMES = sorted(queries.Q)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES) == list(range(1, 14))
    assert set(NAMES) <= set(E.queries()) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, name):
    df = queries.Q[name](spark, SF001)
    assert len({c.lower() for c in df.columns}) == len(df.columns)
    cur = duck(SF001).execute(queries.SQL[name])
    got = fingerprint(df.columns, [tuple(r) for r in df.collect()])
    want = fingerprint([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert got[2] == want[2]
