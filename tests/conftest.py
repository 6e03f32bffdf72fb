import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tradewind.session import build_session, shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tradewind-tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tradewind-tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
