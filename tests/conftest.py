import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barline.schemas import RAW_BARS  # noqa: E402
from barline.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    extra = {}
    # Tests choose their own shared folder only when the environment sets none.
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="barline-ckpt-")
    s = local_session("*", shuffle_partitions=8, app="barline-tests", extra=extra)
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="barline-test-")


def ts(day: int, minute: int, base=dt.datetime(2024, 3, 4, 9, 30)) -> dt.datetime:
    return base + dt.timedelta(days=day, minutes=minute)


def bars_df(spark, rows):
    """rows: (timestamp, open, high, low, close, volume[, bar_count, average])."""
    full = []
    for r in rows:
        r = tuple(r)
        if len(r) == 6:
            r = r + (1, r[4])
        t, o, h, lo, c, v, n, a = r
        f = (lambda x: None if x is None else float(x))
        full.append((t, f(o), f(h), f(lo), f(c), None if v is None else int(v), n, f(a)))
    return spark.createDataFrame(full, RAW_BARS)
