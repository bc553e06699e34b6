import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakestrata.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("work")
    spark = session("tests", "local[*]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g",
                    spark__checkpoint__dir=str(work), spark__sql__warehouse__dir=str(work / "warehouse"))
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
