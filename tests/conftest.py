import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from loomspark.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session("tests", 8, 4, checkpoints=str(tmp_path_factory.mktemp("checkpoints")))


@pytest.fixture(scope="session")
def tables(spark):
    from loomspark.catalog.base import Tables

    return Tables(spark, SF)
