import contextlib
import io
import re

import pytest

import __spark_entry__ as se

SMALL = "/root/testdata/sf0.001"
STREAMING = {"stream_page_audit", "stream_vitals"}


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(se.queries()) - STREAMING))
def test_plan_shape(spark, name):
    text = plan(se.queries()[name](spark, SMALL))
    tree = text.split("\n\n")[0]
    # no cross joins and no pairs emitted per group
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", tree)
    # at most one Python stage per query, and never a row-at-a-time UDF
    assert len(re.findall(r"MapInPandas|MapInArrow", tree)) <= 1
    assert "BatchEvalPython" not in tree
