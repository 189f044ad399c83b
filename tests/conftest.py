import os
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# Python workers import the models that tests define.
os.environ["PYTHONPATH"] = os.pathsep.join([str(HERE), str(HERE.parent), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from boxloom.session import local_session

    folder = str(tmp_path_factory.mktemp("checkpoints"))
    return local_session(4, "tests", **{"spark.checkpoint.dir": folder, "driver_memory": "4g", "spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
