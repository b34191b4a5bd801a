import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cinderframe.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="cinderframe-tests-")
    s = local_session(cpus="*", shuffle_partitions=8, app="cinderframe-tests", checkpoint_dir=ckpt)
    yield s
    s.stop()


@pytest.fixture()
def tmp_table(tmp_path):
    """A fresh table location per test (under pytest's own temporary folder)."""
    counter = {"n": 0}

    def make(name: str = "t") -> str:
        counter["n"] += 1
        return str(tmp_path / f"{name}_{counter['n']}")

    return make


def readings(spark, rows):
    """Raw sensor rows: (date, plant, sensor, value[, is_anomaly])."""
    from cinderframe import schemas

    full = []
    for r in rows:
        d, plant, sensor, value = r[:4]
        anomaly = r[4] if len(r) > 4 else False
        full.append((d, plant, sensor, value, "u", anomaly, dt.datetime(2024, 1, 1)))
    return spark.createDataFrame(full, schemas.RAW_SENSOR_READINGS)
