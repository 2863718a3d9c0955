import datetime as dt
import random

from pyspark.sql import functions as F

from riskloom.operators import ledger as G
from riskloom.operators import results as R
from riskloom.operators.running import in_slices

T0 = dt.datetime(2026, 1, 1)


def test_balance_and_refused_actions(spark):
    rows = [(1, 7, 100.0, "top_up"), (2, 7, 100.0, "subscription_purchase"), (3, 7, 0.0, "top_up"), (4, 7, -5.0, "top_up"),
            (5, 8, 100.0, "subscription_purchase")]
    ev = spark.createDataFrame([(i, u, a, t, T0 + dt.timedelta(hours=i)) for i, u, a, t in rows],
                               "id long, user_id long, amount double, transaction_type string, created_at timestamp")
    ledger = G.ledger_rows(ev)
    got = {r.user_id: (r.balance, r.transactions) for r in G.ledger_balance(ledger).collect()}
    assert got == {7: (0.0, 2), 8: (-100.0, 1)}
    assert [r.id for r in G.overdrawn_purchases(ledger).collect()] == [5]


def test_coverage_equals_the_range_join(spark):
    rnd = random.Random(4)
    subs, ups = [], []
    for i in range(120):
        user = 1 if rnd.random() < 0.5 else rnd.randint(2, 6)   # one hot user
        start = T0 + dt.timedelta(hours=rnd.randint(0, 400))
        subs.append((i, user, start, start + dt.timedelta(hours=rnd.choice([1, 5, 30, 200]))))
        ups.append((i, 1 if rnd.random() < 0.5 else rnd.randint(2, 7), T0 + dt.timedelta(hours=rnd.randint(0, 500))))
    s = spark.createDataFrame(subs, "id long, user_id long, starts_at timestamp, ends_at timestamp")
    u = spark.createDataFrame(ups, "id long, user_id long, created_at timestamp")
    got = {r.id: (r.entitled, r.ends_at) for r in G.active_subscription_asof(u, s, at="created_at").collect()}
    for i, user, at in ups:
        ends = [e for _, su, b, e in subs if su == user and b <= at <= e]
        assert got[i] == (bool(ends), max(ends) if ends else None)
    assert sum(r.entitled for r in G.entitled_uploads(u, s).collect()) == sum(v[0] for v in got.values())


def test_a_busy_day_and_a_busy_instant_are_cut_into_slices(spark):
    """Two thirds of the rows are one user's, on one day, half of them at one instant."""
    rnd = random.Random(8)
    rows = []
    for i in range(3000):
        if i % 3:
            rows.append((i, 1, float(rnd.randint(-50, 50)), T0 + dt.timedelta(seconds=0 if i % 2 else rnd.randint(0, 80_000))))
        else:
            rows.append((i, rnd.randint(2, 5) if i % 9 else None, 1.0, T0 + dt.timedelta(hours=rnd.randint(0, 99))))
    df = spark.createDataFrame(rows, "id long, user_id long, amount double, created_at timestamp")
    cut = in_slices(df, "user_id", ["created_at", "id"], rows=100).groupBy("user_id", "_slice").count().collect()
    assert sum(r["count"] for r in cut) == 3000 and max(r["count"] for r in cut) <= 300
    assert len([r for r in cut if r.user_id == 1]) >= 10
    got = {r.id: float(r.balance_after) for r in G.running_balance(df, rows=100).collect()}
    assert len(got) == 3000
    for user in (1, 2, 3, 4, 5, None):
        total = 0.0
        for i, _, a, _ in sorted((r for r in rows if r[1] == user), key=lambda r: (r[3], r[0])):
            total += a
            assert got[i] == total

    subs = [(j, 1, T0 + dt.timedelta(seconds=60 * j), T0 + dt.timedelta(seconds=60 * j + rnd.choice([5, 30, 4000]))) for j in range(0, 400, 7)]
    s = spark.createDataFrame(subs + [(999, None, T0, T0 + dt.timedelta(days=9))], "id long, user_id long, starts_at timestamp, ends_at timestamp")
    asked = {r.id: (r.entitled, r.ends_at) for r in G.active_subscription_asof(df.drop("amount"), s, at="created_at", rows=100).collect()}
    for i, user, _, at in rows:
        ends = [e for _, u, b, e in subs if u == user and b <= at <= e]
        assert asked[i] == (bool(ends), max(ends) if ends else None)


def test_running_balance_and_latest(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice([1, 1, 1, 2, 3]), float(rnd.randint(-50, 50)), T0 + dt.timedelta(hours=rnd.randint(0, 99))) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, user_id long, amount double, created_at timestamp")
    got = {r.id: float(r.balance_after) for r in G.running_balance(df).collect()}
    for user in (1, 2, 3):
        total = 0.0
        for i, _, a, _ in sorted((r for r in rows if r[1] == user), key=lambda r: (r[3], r[0])):
            total += a
            assert got[i] == total
    newest = R.latest_n(df, 2).select("user_id", "id").collect()
    assert len(newest) == 6


def test_job_state(spark):
    ev = spark.createDataFrame([(1, 1, T0, "uploaded", None), (1, 2, T0, "queued", None), (1, 3, T0 + dt.timedelta(1), "failed", "boom"),
                                (2, 4, T0, "completed", None)], "batch_id long, event_id long, ts timestamp, status string, error_message string")
    got = {r.batch_id: (r.status, r.error_message, r.processed_at is not None) for r in R.job_lifecycle(ev).collect()}
    assert got == {1: ("failed", "boom", True), 2: ("completed", None, True)}


def test_period(spark):
    row = G.subscription_period(spark.createDataFrame([(T0,)], "created_at timestamp")).first()
    assert row.ends_at - row.starts_at == dt.timedelta(days=30)
