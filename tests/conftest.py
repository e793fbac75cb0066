import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidewake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 8, spark__sql__shuffle__partitions="4")


@pytest.fixture(scope="session")
def t(spark):
    from seed import seed_tables

    return seed_tables(spark)
