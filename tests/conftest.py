import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gaugewise.session import local_session

    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session("tests", 8, extra={"spark.sql.warehouse.dir": str(warehouse)})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
