"""Hot keys: one user holds a third of all sessions; results must equal a plain computation."""

import datetime as dt
import random
from collections import Counter, defaultdict

from reelstat.operators.dedup import keep_latest
from reelstat.plans.marts import users

DEVICES = ["Smart TV", "Mobile", "Laptop", "Desktop", "Tablet", None]


def _sessions(n=6000, seed=11):
    rnd = random.Random(seed)
    base = dt.date(2026, 1, 1)
    rows = []
    for i in range(n):
        user = 0 if i % 3 == 0 else rnd.randrange(1, 200)          # user 0: a third of all rows
        rows.append((i, user, rnd.randrange(50), base + dt.timedelta(rnd.randrange(90)),
                     rnd.choice(DEVICES), rnd.choice(["USA", "Canada"]), float(rnd.randrange(1, 120)),
                     float(rnd.randrange(0, 11) * 10), "started", rnd.choice(["SD", "HD", "4K"]),
                     rnd.random() < 0.2, None, rnd.random() < 0.4))
    return rows


SCHEMA = ("session_id long, user_id long, movie_id long, watch_date date, device_type string, "
          "location_country string, watch_duration_minutes double, progress_percentage double, action string, "
          "quality string, is_download boolean, user_rating double, is_completed boolean")


def _mode(values):
    c = Counter(values)
    return min(c.items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))[0]


def test_user_watch_with_a_hot_user(spark):
    rows = _sessions()
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    got = {r.user_id: r for r in users.user_watch(df).collect()}
    by_user = defaultdict(list)
    for r in rows:
        by_user[r[1]].append(r)
    assert set(got) == set(by_user)
    for u, rs in by_user.items():
        g = got[u]
        assert g.total_sessions == len(rs)
        assert g.unique_titles_watched == len({r[2] for r in rs})
        assert g.active_watch_days == len({r[3] for r in rs})
        assert g.preferred_device == _mode([r[4] for r in rs])
        assert g.preferred_quality == _mode([r[9] for r in rs])
        assert g.completed_sessions == sum(r[12] for r in rs)
    assert got[0].total_sessions == 2000


def test_keep_latest_with_a_hot_key_many_copies(spark):
    rnd = random.Random(5)
    rows = [(0 if i % 3 == 0 else i, f"2026-01-{rnd.randrange(1, 29):02d}", rnd.randrange(10**6)) for i in range(9000)]
    df = spark.createDataFrame(rows, "id long, _ingestion_date string, payload long").repartition(8)
    got = {r.id: (r._ingestion_date, r.payload) for r in keep_latest(df, ["id"], "_ingestion_date").collect()}
    want = {}
    for k, d, p in rows:
        want[k] = max(want.get(k, (d, p)), (d, p))
    assert got == want
