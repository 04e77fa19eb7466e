import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from topicweave.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions=4, spark__checkpoint__dir=tempfile.mkdtemp(prefix="tests-")
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def toy(spark):
    """Three documents, five terms."""
    rows = [
        (0, "eat", 1), (0, "fish", 1), (0, "vegetable", 1), (1, "fish", 1), (1, "pet", 1),
        (2, "kitten", 1), (2, "eat", 1), (2, "fish", 3),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, word string, n bigint")


@pytest.fixture(scope="session")
def toy_labels(spark):
    return spark.createDataFrame([(0, "a", 0), (1, "b", 1), (2, "a", 0)], "doc_id bigint, category string, y int")
