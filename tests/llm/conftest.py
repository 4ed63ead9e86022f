import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_samples import EDGE_IDS, EDGE_TEXTS, docs_of  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    from wardline.session import get_session

    yield get_session("local[4]", shuffle_partitions=4)


@pytest.fixture(scope="session")
def edge(spark):
    return docs_of(spark, EDGE_TEXTS, EDGE_IDS, extra=True)


@pytest.fixture(scope="session")
def empty(spark):
    return docs_of(spark, [])
