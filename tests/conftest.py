import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog.session import checkpoint_dir, get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[*]", shuffle_partitions=8, app="tidelog-tests")
    checkpoint_dir(s)          # unset in tests: a fresh folder is registered
    yield s
    s.stop()


@pytest.fixture
def scratch():
    """A new scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="tidelog-test-", dir="/tmp")


def log_rows(spark, rows):
    """Hand-written log rows: (key, value, topic, partition, offset, ts)."""
    from tidelog.log import LOG_SCHEMA
    from datetime import datetime
    fixed = []
    for k, v, t, p, o, ts in rows:
        kb = k.encode() if isinstance(k, str) else k
        vb = v.encode() if isinstance(v, str) else v
        fixed.append((kb, vb, t, p, o, datetime.fromisoformat(ts) if isinstance(ts, str) else ts))
    return spark.createDataFrame(fixed, LOG_SCHEMA)
