from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tweetflow.functions.scorers import lexicon_scorer  # noqa: E402
from tweetflow.plans.feed import LEXICON  # noqa: E402
from tweetflow.session import build_session, shared_dir  # noqa: E402
from tweetflow.sources.files import make_scratch  # noqa: E402
from tweetflow.sources.tables import Layout  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tweetflow-tests",
        master="local[8]",
        shuffle_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def new_dir(spark):
    """Names unused paths in directories that are removed with the session."""
    return lambda label: f"{make_scratch(spark, shared_dir(spark, label))}/{label}"


@pytest.fixture
def layout(new_dir):
    return Layout(new_dir("layout"))


@pytest.fixture(scope="session")
def scorer():
    return lexicon_scorer(LEXICON)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
