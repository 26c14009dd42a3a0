import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from robustagg.session import build_session, ensure_checkpoint_dir
    s = build_session("local[4]", shuffle_partitions=8, app_name="robustagg-tests")
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def point_frame(spark, rows):
    """rows: list of (point_id, [coords])."""
    return spark.createDataFrame([(int(i), [float(x) for x in f]) for i, f in rows],
                                 "point_id long, features array<double>")
