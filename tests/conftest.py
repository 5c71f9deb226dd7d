import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from starsync.session import build_session

    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "3",
        "spark.default.parallelism": "2",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    return session
