from __future__ import annotations

import shutil
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from geoingest import build_session  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")


# Column expressions in test modules and parameters need a session while they are collected.
_WORK = Path(tempfile.mkdtemp(prefix="geoingest-tests-"))
_SESSION = build_session(
    "tests",
    "local[8]",
    spark__sql__shuffle__partitions="8",
    spark__ui__enabled="false",
    spark__driver__memory="6g",
    spark__sql__warehouse__dir=str(_WORK / "warehouse"),
    spark__checkpoint__dir=str(_WORK / "checkpoints"),
)
_SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield _SESSION
    _SESSION.stop()
    shutil.rmtree(_WORK, ignore_errors=True)
