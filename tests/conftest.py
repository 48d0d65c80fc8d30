from __future__ import annotations

import logging
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    logging.getLogger("DataFrameQueryContextLogger").disabled = True
    made = session.build(
        "local[4]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    made.sparkContext.setLogLevel("OFF")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("the test tables are not here")
    return str(path)
