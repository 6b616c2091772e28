import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from spendmill.plans.store import Store  # noqa: E402
from spendmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"t_{tmp_path.name.replace('-', '_')}_{abs(hash(str(tmp_path))) % 10**9}", str(tmp_path))
