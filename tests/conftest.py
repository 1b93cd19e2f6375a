import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerolake.schema import RAW_SCHEMA  # noqa: E402
from aerolake.session import get_session  # noqa: E402
from raw_rows import MOCK_ROWS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app_name="aerolake-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="aerolake-wh-")})
    yield s


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="aerolake-test-")


@pytest.fixture()
def mock(spark):
    return spark.createDataFrame(MOCK_ROWS, RAW_SCHEMA)
