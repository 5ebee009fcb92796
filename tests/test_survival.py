"""Maturity with open rows against a plain estimate, day by day."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from lapsekit.operators.survival import approvals_backtest, censored_maturity, days_at_risk, product_limit
from lapsekit.spec import DEFAULT_SPEC

SCHEMA = "source string, merchant_id string, purchase_date date, status string, status_updated_date date"
AS_OF = dt.date(2025, 6, 30)


def made(seed=3, n=400):
    rng, out = random.Random(seed), []
    for _ in range(n):
        bought = dt.date(2025, 1, 1) + dt.timedelta(days=rng.randrange(220)) if rng.random() > 0.02 else None
        status = rng.choice(["approved", "approved", "rejected", "pending", None])
        decided = None
        if status in ("approved", "rejected") and bought and rng.random() > 0.05:
            decided = bought + dt.timedelta(days=rng.randrange(-3, 120))
        out.append((rng.choice(["N", "Z", None]), rng.choice(["M1", "M2", "M3", None]) if rng.random() > 0.02 else "thin", bought, status, decided))
    return out


def plain(rows, as_of):
    """{day: (at_risk, undecided, approved_share)} of the rows of one group."""
    seen = []
    for _, _, bought, status, decided in rows:
        if bought and bought <= as_of:
            done = decided is not None and decided <= as_of
            seen.append((max(0, ((decided if done else as_of) - bought).days), done, status == "approved"))
    out, left, share = {}, 1.0, 0.0
    for day in sorted({t for t, _, _ in seen}):
        n = sum(t >= day for t, _, _ in seen)
        d = sum(t == day and done for t, done, _ in seen)
        share += left * sum(t == day and done and yes for t, done, yes in seen) / n
        left *= 1 - d / n
        out[day] = (n, left, share)
    return out


@pytest.mark.parametrize("keys", [["source"], ["source", "merchant_id"]])
def test_curve(spark, keys):
    rows = made()
    got = defaultdict(dict)
    for r in product_limit(days_at_risk(spark.createDataFrame(rows, SCHEMA), AS_OF), keys).collect():
        got[tuple(r[k] for k in keys)][r["day"]] = (r["at_risk"], r["undecided"], r["approved_share"])
    groups = defaultdict(list)
    for r in rows:
        groups[r[:len(keys)]].append(r)
    want = {k: plain(v, AS_OF) for k, v in groups.items()}
    want = {k: v for k, v in want.items() if v}
    assert got.keys() == want.keys()
    for k, days in want.items():
        assert got[k].keys() == days.keys()
        for t, v in days.items():
            assert got[k][t] == pytest.approx(v, abs=1e-12)


def test_open_rows_lift_the_bias_of_young_cohorts(spark):
    """Half of all transactions are approved on day 60, half rejected on day 5: the decided rows of a young
    cohort say that nearly all are rejected."""
    rows = [("N", "M", dt.date(2025, 1, 1) + dt.timedelta(days=i % 180), "approved" if i % 2 else "rejected",
             dt.date(2025, 1, 1) + dt.timedelta(days=i % 180 + (60 if i % 2 else 5))) for i in range(1800)]
    df = spark.createDataFrame(rows, SCHEMA)
    as_of = dt.date(2025, 3, 20)
    young = df.filter("status_updated_date <= DATE '2025-03-20'")
    naive = young.filter("status = 'approved'").count() / young.count()
    got = censored_maturity(df, as_of, DEFAULT_SPEC).first()
    assert naive < 0.2 and abs(got["eventually_approved"] - 0.5) < 0.02
    back = approvals_backtest(df, [as_of]).first()
    assert abs(back["expected_approvals"] - back["approvals_that_came"]) < 0.05 * back["open_transactions"]


def test_thin_merchants_are_drawn_to_their_network(spark):
    rows = [("N", "big", dt.date(2025, 1, 1), "approved" if i % 4 else "rejected", dt.date(2025, 1, 9)) for i in range(400)]
    rows += [("N", "thin", dt.date(2025, 1, 1), "rejected", dt.date(2025, 1, 9))]
    got = {r["merchant_id"]: r for r in censored_maturity(spark.createDataFrame(rows, SCHEMA), AS_OF).collect()}
    assert got["thin"]["eventually_approved"] == 0 and 0.65 < got["thin"]["eventually_approved_drawn"] < 0.75
    assert abs(got["big"]["eventually_approved_drawn"] - 0.75) < 0.01


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert censored_maturity(empty, AS_OF).collect() == [] and approvals_backtest(empty, [AS_OF]).collect() == []
