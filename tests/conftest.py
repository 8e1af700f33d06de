import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from stewardry.session import local_session

    session = local_session("stewardry-tests", cpus=8)
    session.sparkContext.setLogLevel("ERROR")
    # Small frames spend their time in compiling, not in running.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()
