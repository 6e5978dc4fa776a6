from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from punctual.session import get_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    events = folder / "events"
    events.mkdir()
    session = get_session(
        "tests",
        master="local[8]",
        spark__driver__memory="6g",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=f"file://{folder}/checkpoint",
        spark__sql__warehouse__dir=f"file://{folder}/catalog",
        spark__eventLog__enabled="true",
        spark__eventLog__dir=f"file://{events}",
        spark__eventLog__compress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
