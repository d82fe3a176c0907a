from __future__ import annotations

import sys
from pathlib import Path

import pytest

from lustra.llm.shipping import ship_package

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)
