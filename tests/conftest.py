from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sessionmart import schemas  # noqa: E402
from sessionmart.config import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="sessionmart-test-")
    s = get_session(master="local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": os.path.join(root, "ckpt"),
                           "spark.sql.warehouse.dir": os.path.join(root, "warehouse")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sessionmart-test-")


def utc(*a) -> dt.datetime:
    return dt.datetime(*a)


def bars_df(spark, rows):
    """rows: (utc datetime, open, high, low, close, volume, symbol) -> raw bars (NTZ)."""
    data = [(ts, float(o), float(h), float(lo), float(c), float(v), None, sym)
            for ts, o, h, lo, c, v, sym in rows]
    return spark.createDataFrame(data, schemas.BARS_NTZ)
