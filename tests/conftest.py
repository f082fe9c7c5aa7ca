import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vulnloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "vulnloom-tests", master="local[4]", **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no driver tables on this machine")
    return str(path)


@pytest.fixture
def path(tmp_path):
    """A fresh path that does not exist yet."""
    return str(tmp_path / "out")
