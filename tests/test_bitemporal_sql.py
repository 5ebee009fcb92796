"""Identity on two time axes, by brute force; the model's SQL functions."""

import datetime as dt
import random
from decimal import Decimal

from support import FIXTURES

from lapsekit.operators.bitemporal import activity_as_known, identity_restatement
from lapsekit.operators.staging import stage_cashback, stage_coupons
from lapsekit.sources.feeds import CASHBACK_SCHEMA, COUPON_SCHEMA
from lapsekit.spec import DEFAULT_SPEC

MAP = ("source_system string, source_user_id string, unified_user_id string, valid_from date, valid_to date, "
       "known_from date, known_to date")


def day(rng, none=0.2):
    return None if rng.random() < none else dt.date(2025, 1, 1) + dt.timedelta(days=rng.randrange(365))


def made(seed):
    rng = random.Random(seed)
    ids = [(rng.choice(["coupon", "cashback"]), f"B{rng.randrange(12)}", f"U{rng.randrange(6)}", *(day(rng, 0.5) for _ in range(4)))
           for _ in range(40)]
    coupons = [(f"E{i}", f"B{rng.randrange(14)}", day(rng, 0.05), "M", rng.choice(["coupon_copy", "coupon_view"])) for i in range(60)]
    cash = [(f"T{i}", f"B{rng.randrange(14)}", day(rng, 0.05), "M", "N", rng.choice(["approved", "pending", "rejected"]), day(rng), Decimal(1))
            for i in range(80)]
    return ids, coupons, cash


def plain(ids, coupons, cash, as_of, known):
    """{(person, quarter): (baseline, approved_only)}."""
    out = {}
    events = [("coupon", u, d, "approved" if t == "coupon_copy" else "no") for _, u, d, _, t in coupons]
    events += [("cashback", u, d, s if x and x <= as_of else "pending") for _, u, d, _, _, s, x, _ in cash]
    for channel, user, d, word in events:
        if d is None or d > as_of or d.year != 2025:
            continue
        people = {p for s, i, p, f, t, kf, kt in ids if (s, i) == (channel, user) and (kf is None or kf <= known)
                  and (kt is None or kt >= known) and (f is None or f <= d) and (t is None or t >= d)}
        if len(people) == 1:
            key = (people.pop(), f"2025Q{(d.month + 2) // 3}")
            a, b = out.get(key, (False, False))
            out[key] = (a or word in ("approved", "pending"), b or word == "approved")
    return out


def test_two_dates_by_brute_force(spark):
    for seed in (1, 2):
        ids, coupons, cash = made(seed)
        m = spark.createDataFrame(ids, MAP)
        c = stage_coupons(spark.createDataFrame(coupons, COUPON_SCHEMA))
        t = stage_cashback(spark.createDataFrame(cash, CASHBACK_SCHEMA))
        as_of = dt.date(2025, 9, 30)
        for known in (dt.date(2025, 3, 1), dt.date(2025, 12, 31)):
            got = {(r["unified_user_id"], r["quarter_label"]): (r["is_active_baseline"], r["is_active_approved_only"])
                   for r in activity_as_known(c, t, m, as_of, known).collect()}
            assert got == plain(ids, coupons, cash, as_of, known)


def test_a_merge_restates_history(spark):
    d = dt.date
    ids = [("cashback", "B1", "U1", None, None, None, d(2025, 5, 31)), ("cashback", "B1", "U2", None, None, d(2025, 6, 1), None),
           ("cashback", "B2", "U2", None, None, None, None)]
    cash = [("T1", "B1", d(2025, 1, 5), "M", "N", "approved", d(2025, 1, 6), Decimal(1)),
            ("T2", "B2", d(2025, 2, 5), "M", "N", "approved", d(2025, 2, 6), Decimal(1))]
    got = identity_restatement(stage_coupons(spark.createDataFrame([], COUPON_SCHEMA)), stage_cashback(spark.createDataFrame(cash, CASHBACK_SCHEMA)),
                               spark.createDataFrame(ids, MAP), d(2025, 12, 31), d(2025, 5, 1), d(2025, 7, 1)).collect()
    assert {tuple(r) for r in got} == {(n, "2025Q1", 2, 1, 1, 0) for n in ("baseline", "approved_only")}


def test_sql_functions(spark, golden):
    from lapsekit.functions.sql import function_texts, register
    assert register(golden) == list(function_texts(DEFAULT_SPEC))
    as_of = dt.date(2025, 6, 30)
    a, b = spark.sql("SELECT * FROM activity_as_of(DATE '2025-06-30')"), golden.activity_as_of(as_of)
    assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    row = spark.sql("SELECT period_start(DATE '2025-05-17'), period_end(DATE '2025-05-17'), period_label(DATE '2025-05-17'), "
                    "period_label(NULL), in_analysis_period(NULL), status_as_of('approved', DATE '2025-07-01', DATE '2025-06-30')").first()
    assert tuple(row) == (dt.date(2025, 4, 1), as_of, "2025Q2", None, False, "pending")
    months = spark.sql("SELECT count(*) FROM activity_as_of(DATE '2025-06-30') t JOIN churn_fact f USING (unified_user_id, quarter_label) "
                       "WHERE t.is_active_baseline AND NOT f.is_active_baseline").first()[0]
    assert months >= 0 and FIXTURES


def test_sql_functions_of_other_grains(spark):
    from lapsekit.functions.periods import period_end, period_label, period_start
    from lapsekit.functions.sql import function_texts
    from pyspark.sql import functions as F
    days = spark.range(400).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("d"))
    days.createOrReplaceTempView("some_days")
    for grain in ("week", "month", "quarter"):
        for name in ("period_start", "period_end", "period_label"):
            spark.sql(function_texts(DEFAULT_SPEC.with_(grain=grain))[name])
        got = spark.sql("SELECT d, period_start(d), period_end(d), period_label(d) FROM some_days").collect()
        want = days.select("d", period_start("d", grain), period_end(period_start("d", grain), grain), period_label("d", grain)).collect()
        assert list(map(tuple, got)) == list(map(tuple, want))
