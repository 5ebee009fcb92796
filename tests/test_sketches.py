import datetime as dt
import random
from collections import defaultdict

import pytest

from lapsekit.operators import sketches as K

SCHEMA = "source string, purchase_date date, cashback_user_id string, days_to_status_decision int"
RANGES = [(dt.date(2025, 1, 1), dt.date(2025, 1, 1)), (dt.date(2025, 2, 1), dt.date(2025, 5, 1)), (dt.date(2024, 1, 1), dt.date(2026, 1, 1))]


def made(n=30_000, seed=2):
    rnd = random.Random(seed)
    rows = [(rnd.choice("AAAAB"), dt.date(2025, 1, 1) + dt.timedelta(days=rnd.randrange(200)), f"u{int(rnd.paretovariate(0.5)) % 20_000}",
             rnd.choice([None, int(rnd.expovariate(0.05))])) for _ in range(n)]
    return rows + [("A", None, "u1", 3), (None, dt.date(2025, 2, 3), None, None), (None, dt.date(2025, 2, 3), "x", 7), ("C", dt.date(2025, 1, 9), None, None)]


@pytest.fixture(scope="module")
def feed(spark):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    return rows, df, K.feed_sketches(df)


def test_users_of_ranges(feed):
    rows, df, sk = feed
    want = defaultdict(set)
    count = defaultdict(int)
    for s, day, u, _ in rows:
        for a, b in RANGES:
            if day and a <= day.replace(day=1) <= b:
                for g in (s, "ALL SOURCES"):
                    count[g, a, b] += 1
                    want[g, a, b] |= {u} - {None}
    got = {(r["source"], r["from_month"], r["to_month"]): r for r in K.users_in_ranges(sk, RANGES).collect()}
    assert got.keys() == count.keys()
    for k, r in got.items():
        assert r["transactions"] == count[k]
        assert abs(r["users"] - len(want[k])) <= K.USERS_ERROR * len(want[k])
    check = K.users_check(sk, df, RANGES).collect()
    assert len(check) == len(got) and all(r["within_error"] for r in check)
    assert {(r["source"], r["from_month"], r["to_month"]): r["exact_users"] for r in check} == {k: len(want[k]) for k in count}


def test_quantiles_of_all_months(feed):
    rows, df, sk = feed
    days = defaultdict(list)
    for s, _, _, d in rows:
        if d is not None:
            days[s].append(d)
            days["ALL SOURCES"].append(d)
    got = K.decision_quantiles(sk, (0.1, 0.5, 0.99)).collect()
    assert {(r["source"], r["share"]) for r in got} == {(s, p) for s in days for p in (0.1, 0.5, 0.99)}
    for r in got:
        d = days[r["source"]]
        assert r["decided_transactions"] == len(d)
        assert sum(x < r["days"] for x in d) <= (r["share"] + K.RANK_ERROR) * len(d)
        assert sum(x <= r["days"] for x in d) >= (r["share"] - K.RANK_ERROR) * len(d)
    check = K.quantiles_check(sk, df).collect()
    assert len(check) == 3 * len(days) and all(r["within_rank_error"] for r in check)


def test_restated_months_are_sketched_anew(spark, feed):
    rows, df, sk = feed
    new = [(s, day, "one" if day and day.month == 3 else u, d) for s, day, u, d in rows if day is not None]
    after = K.refreshed(sk, spark.createDataFrame(new, SCHEMA), [dt.date(2025, 3, 1), None])
    march = [(dt.date(2025, 3, 1), dt.date(2025, 3, 1))]
    assert {r["users"] for r in K.users_in_ranges(after, march).collect()} == {1}
    assert after.filter("month IS NULL").count() == 0
    full = K.users_in_ranges(K.feed_sketches(spark.createDataFrame(new, SCHEMA)), RANGES)
    assert sorted(map(repr, K.users_in_ranges(after, RANGES).collect())) == sorted(map(repr, full.collect()))


def test_empty_feed(spark):
    sk = K.feed_sketches(spark.createDataFrame([], SCHEMA))
    assert sk.collect() == [] and K.users_in_ranges(sk, RANGES).collect() == []
    assert K.decision_quantiles(sk).collect() == []
