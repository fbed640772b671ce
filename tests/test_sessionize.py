"""Bucketed sessionisation against the plain lag-based definition."""

import datetime as dt
import random

import pandas as pd

from shoplens.operators.sessionize import assign_sessions, sessionize

GAP = 6 * 3600


def brute(events: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for u, g in events.sort_values(["ts", "event_id"]).groupby("user_id"):
        start = None
        for _, r in g.iterrows():
            if start is None or (r.ts - prev).total_seconds() >= GAP:
                if start is not None:
                    rows.append(cur)
                start = r.ts
                cur = {"user_id": u, "session_id": r.event_id, "start": r.ts, "end": r.ts, "n": 0}
            cur["end"] = r.ts
            cur["n"] += 1
            cur["session_id"] = min(cur["session_id"], r.event_id)
            prev = r.ts
        rows.append(cur)
    return pd.DataFrame(rows)


def test_sessions_match_lag_definition(spark):
    rnd = random.Random(17)
    base = dt.datetime(2024, 1, 1)
    rows, eid = [], 0
    for u in range(4):
        t = base + dt.timedelta(seconds=rnd.randint(0, 20000))
        for _ in range(120 if u == 0 else 25):  # user 0 is the hot key
            # gaps cluster around the 6 h boundary, including exactly 6 h
            t = t + dt.timedelta(seconds=rnd.choice([60, 3600, GAP - 1, GAP, GAP + 1, 2 * GAP, 30000]))
            rows.append((eid, u, t))
            eid += 1
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp")
    got = sessionize(ev, "user_id", "ts", "event_id", GAP).toPandas().sort_values("session_id").reset_index(drop=True)
    exp = brute(pd.DataFrame(rows, columns=["event_id", "user_id", "ts"])).sort_values("session_id").reset_index(drop=True)
    assert list(got.session_id) == list(exp.session_id)
    assert list(got.pages_visited) == list(exp.n)
    assert list(got.duration_secs) == [int((e - s).total_seconds()) for s, e in zip(exp.start, exp.end)]
    tagged = assign_sessions(ev, "user_id", "ts", "event_id", GAP).toPandas()
    assert tagged.session_id.notna().all()
    assert tagged.groupby("session_id").size().sort_index().tolist() == exp.set_index("session_id").n.sort_index().tolist()
