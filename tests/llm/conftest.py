import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from aerolake.session import get_session  # noqa: E402
from corpus_rows import ROWS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_session("local[*]", app_name="aerolake-tests", shuffle_partitions=8,
                       extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="aerolake-wh-")})


@pytest.fixture(scope="session")
def docs(spark):
    """The edge rows with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "s", 0, 7, True, "w", 1.0) for r in ROWS],
                                 "doc_id long, text string, lang string, source string, n_chars long, n_words long, "
                                 "kept boolean, words string, score double").repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("false")
