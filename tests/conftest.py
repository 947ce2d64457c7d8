from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkmart.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def log(mid, ts, page_id="home", last_page_id=None, event_id=None, is_new="0", displays=(), start=None, **more):
    """One log message as text."""
    page = {"page_id": page_id, "last_page_id": last_page_id, **more}
    message = {
        "common": {"mid": mid, "vc": "v1", "ch": "c1", "ar": "a1", "is_new": is_new},
        "page": {k: v for k, v in page.items() if v is not None},
        "displays": list(displays),
        "ts": ts,
    }
    if start is not None:
        message["start"] = start
    if event_id is not None:
        message["event_id"] = event_id
    return json.dumps(message)


@pytest.fixture(scope="session")
def logs_of(spark):
    from sparkmart.functions.jsonutil import split_corrupt
    from sparkmart.operators.logs import decode_logs
    from sparkmart.sources.topics import literal_topic

    def make(*messages: str):
        return split_corrupt(decode_logs(literal_topic(spark, list(messages))))[0]

    return make
