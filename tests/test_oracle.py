"""Every query with oracle text: Spark result == DuckDB result (rows, columns, exact values)."""

import contextlib
import hashlib
import io
import math

import pytest

from __spark_entry__ import oracle_sql, queries

from .conftest import SF_SMALL

ORACLE = oracle_sql()


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return repr(v.item() if hasattr(v, "item") else v)

    keyed = sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()


# plan nodes that would break the scale rules: all-pairs joins, per-row Python UDFs
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    plan = _plan(df)
    assert not [f for f in FORBIDDEN if f in plan], plan
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, df.columns) == _digest(drows, dcols)


def test_every_query_has_a_builder():
    assert set(ORACLE) <= set(queries())
