import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from corpusloom.session import build_session

    os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])
    s = build_session("tests", "local[4]", {"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"})
    s.sparkContext.setLogLevel("ERROR")
    return s
