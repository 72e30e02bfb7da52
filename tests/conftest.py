import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tallyhouse.plans.workspace import close_workspaces  # noqa: E402
from tallyhouse.session import StagingArea, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tallyhouse-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    close_workspaces(session)
    session.stop()


@pytest.fixture
def area(spark):
    staging = StagingArea(spark)
    yield staging
    staging.clear()
