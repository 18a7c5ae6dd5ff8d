import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
sys.path.insert(0, str(Path(__file__).parent / "llm"))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from brevetlake.session import session

    spark = session(
        "tests",
        os.environ.get("TEST_MASTER", "local[4]"),
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
