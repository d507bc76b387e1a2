from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fanpulse.session import get_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app_name="fanpulse-tests", extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    from fanpulse.sources.bindings import canonical_tables

    return canonical_tables(spark, SF0001)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def app_events(spark, rows):
    """rows: (event_id, user_id, ts, event_name[, match_id, revenue, session, platform, variant, content])."""
    from fanpulse.schemas import CONTRACTS

    out = []
    for r in rows:
        eid, uid, t, name = r[:4]
        match_id = r[4] if len(r) > 4 else 1
        rev = r[5] if len(r) > 5 else (9.99 if name == "subscription_start" else 0.0)
        sess = r[6] if len(r) > 6 else f"s{uid}"
        platform = r[7] if len(r) > 7 else "ios"
        variant = r[8] if len(r) > 8 else "control"
        content = r[9] if len(r) > 9 else None
        t = ts(t)
        out.append((eid, uid, sess, t, t.date(), name, match_id, content, platform, "organic", variant, None, rev))
    return spark.createDataFrame(out, CONTRACTS["fact_app_events"])
