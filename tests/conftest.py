import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from sitelens.session import build_session
    s = build_session("local[4]", app="sitelens-tests", shuffle_partitions=4)
    yield s
    s.stop()


def snap_df(spark, rows):
    """rows: list of (url, status, html[, content_type[, fetch_error]])."""
    full = []
    for r in rows:
        url, status, html = r[:3]
        ct = r[3] if len(r) > 3 else "text/html; charset=utf-8"
        err = r[4] if len(r) > 4 else None
        full.append((url, status, ct, html, err))
    return spark.createDataFrame(
        full, "url string, status int, content_type string, html string, fetch_error string")
