import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from trisect.operators import ranking  # noqa: E402
from trisect.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def tiny_buckets(monkeypatch):
    """Buckets as a large table gets them: many, cut into parts, frequent values spread by hash."""
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 3)
    monkeypatch.setattr(ranking, "SMALL_BUCKET_ROWS", 3)
    monkeypatch.setattr(ranking, "MIN_BUCKETS", 8)
    monkeypatch.setattr(ranking, "BUCKETS", 32)
    monkeypatch.setattr(ranking.fit_buckets, "__defaults__", (32,))
