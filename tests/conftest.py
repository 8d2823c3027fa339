from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path[:0] = [ROOT, str(Path(ROOT, "tests"))]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vigora.session import local_session

    made = local_session(4, 4, "4g")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
