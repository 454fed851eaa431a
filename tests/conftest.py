import sys
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from candlewick.session import local_session  # noqa: E402
from candlewick.sources.scratch import scratch_path  # noqa: E402
from candlewick.sources.tables import setup_tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests")
    yield session
    session.stop()


@pytest.fixture
def schema(spark):
    """Empty silver and audit tables under a schema of their own."""
    name = f"t_{uuid.uuid4().hex}"
    setup_tables(spark, name, scratch_path(spark, name))
    return name


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "test")
