"""sessionize against a brute-force Python model of the rule, on random inputs."""

import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from activitykit import sessionize

BASE = dt.datetime(2019, 10, 1)
SCHEMA = ("user_id long, event_time_utc timestamp, product_id long, event_type string, dedup_key string, "
          "event_time_kst timestamp")


def _expected(events, seeds, gap):
    """events: (user, t, product, type, key); seeds: user -> (last_t, start)."""
    out = {}
    by_user = {}
    for e in events:
        by_user.setdefault(e[0], []).append(e)
    for user, rows in by_user.items():
        rows.sort(key=lambda e: (e[1], e[2], e[3], e[4]))
        prev, start = None, None
        seed = seeds.get(user)
        if seed is not None and seed[0] is not None:
            prev = seed[0]
        for i, e in enumerate(rows):
            sec = int(e[1].timestamp())
            if prev is None:
                start = e[1]
            else:
                g = sec - int(prev.timestamp())
                if g >= gap or g < 0:
                    start = e[1]
                elif i == 0:
                    start = seed[1]  # continued from the snapshot
            prev = e[1]
            out[e[4]] = start
    return out


def _sid(user, start):
    ms = "__null__" if start is None else str(int(start.replace(tzinfo=dt.timezone.utc).timestamp() * 1000))
    return hashlib.sha256(f"{user}||{ms}".encode()).hexdigest()


events_st = st.lists(
    st.tuples(
        st.integers(1, 3),  # user
        st.integers(0, 4000),  # seconds after BASE
        st.sampled_from([0, 250_000, 900_000]),  # microseconds
        st.integers(1, 3),  # product
        st.sampled_from(["view", "cart"]),
    ),
    min_size=1,
    max_size=40,
)
seed_st = st.dictionaries(
    st.integers(1, 4),
    st.tuples(st.one_of(st.none(), st.integers(-2000, 600)), st.one_of(st.none(), st.integers(-4000, -1))),
    max_size=4,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=events_st, seeds=seed_st, gap=st.sampled_from([60, 300, 1800]), split=st.booleans())
def test_matches_brute_force(spark, events, seeds, gap, split):
    rows, seen = [], set()
    for i, (u, s, us, p, t) in enumerate(events):
        ts = BASE + dt.timedelta(seconds=s, microseconds=us)
        key = f"k{i:03d}"
        if (u, ts, p, t) in seen:
            continue
        seen.add((u, ts, p, t))
        rows.append((u, ts, p, t, key, ts + dt.timedelta(hours=9)))
    seed_rows = {
        u: (None if last is None else BASE + dt.timedelta(seconds=last),
            None if start is None else BASE + dt.timedelta(seconds=start))
        for u, (last, start) in seeds.items()
    }
    df = spark.createDataFrame(rows, SCHEMA)
    snap = spark.createDataFrame(
        [(u, last, start) for u, (last, start) in seed_rows.items()],
        "user_id long, last_event_time_utc timestamp, last_session_start_time_utc timestamp",
    ) if seed_rows else None
    out = sessionize(df, snap, gap_seconds=gap, max_user_rows=3 if split else None,
                     with_session_opened=True)
    got = {r.dedup_key: (r.session_start_time_utc, r.session_id) for r in
           out.select("dedup_key", "session_start_time_utc", "session_id").collect()}
    want = _expected([r[:5] for r in rows], seed_rows, gap)
    assert {k: v[0] for k, v in got.items()} == want
    users = {r[4]: r[0] for r in rows}
    assert all(v[1] == _sid(users[k], v[0]) for k, v in got.items())
    assert out.where(F.col("session_id").isNull()).count() == 0
    assert out.where("session_opened").count() == len({v[1] for v in got.values()})
