import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockrisk.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    places = {"spark.checkpoint.dir": f"{root}/checkpoints", "spark.sql.warehouse.dir": f"{root}/warehouse"}
    s = build_session("local[4]", shuffle_partitions=4, app_name="stockrisk-tests", extra=places)
    yield s
    s.stop()
