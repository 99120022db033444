from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidelake.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, memory="6g", app="tests")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a DataFrame as sorted tuples; nulls come first."""

    def collect(df):
        return sorted(
            (tuple(r) for r in df.collect()),
            key=lambda row: [(value is not None, str(value)) for value in row],
        )

    return collect
