from __future__ import annotations

import pytest

from sparkmart.llm.common import ship
from sparkmart.staging import Staging


@pytest.fixture(scope="session")
def sent(spark):
    """The session, with the package at the workers."""
    ship(spark)
    return spark


@pytest.fixture
def docs(sent):
    """Documents from (doc_id, text) rows, with columns whose names operators use inside."""

    def make(rows):
        wide = [(i, t, "en", "host", 1, 2, "x", 0.5) for i, t in rows]
        return sent.createDataFrame(
            wide, "doc_id LONG, text STRING, lang STRING, source STRING, row LONG, bucket LONG, t STRING, score DOUBLE"
        )

    return make


@pytest.fixture
def fresh(sent, tmp_path):
    return Staging(sent, str(tmp_path))
