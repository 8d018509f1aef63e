from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__warehouse__dir="/tmp/tidemark-warehouse")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
