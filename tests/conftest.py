import json
import os
import sys
from datetime import datetime, timezone

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from commitlake.session import build_session  # noqa: E402
from commitlake.sources.schemas import ENVELOPE  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8, app="commitlake-tests")
    yield s
    s.stop()


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(timezone.utc)


@pytest.fixture()
def envelope(spark):
    """Build a raw stream from (payload dict | raw JSON text, extracted ISO time[, sequence]) tuples."""

    def make(records):
        rows = []
        for i, rec in enumerate(records):
            payload, extracted = rec[0], rec[1]
            seq = rec[2] if len(rec) > 2 else i
            data = payload if isinstance(payload, str) or payload is None else json.dumps(payload)
            t = ts(extracted)
            rows.append((data, t, t, t, None, seq, 1))
        return spark.createDataFrame(rows, ENVELOPE)

    return make
