import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.session import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "plumbline-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": str(root / "shared"), "spark.driver.memory": "8g",
           "spark.sql.warehouse.dir": str(root / "warehouse")},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def plan():
    """The physical plan of a frame as text."""
    from plumbline.plans.report import _plan_text

    return _plan_text
