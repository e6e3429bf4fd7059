import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tracemill.session import build_session  # noqa: E402
from tracemill.sources.files import as_files  # noqa: E402

STAMP = datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_files(spark):
    """Files from a dict of path to bytes."""

    def make(contents: dict[str, bytes]):
        rows = [(path, bytearray(data), STAMP) for path, data in contents.items()]
        return as_files(spark.createDataFrame(rows, "path STRING, content BINARY, mtime TIMESTAMP_NTZ"))

    return make
