import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(8, "8g", spark__sql__warehouse__dir=warehouse)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
