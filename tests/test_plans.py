"""Plan-shape guards: no cross joins / nested-loop joins, no row-at-a-time Python UDFs."""

import contextlib
import io

import pytest

from cartwise.plans import catalog

from paths import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDF
