"""Staging and transitions against a plain-Python brute force on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lapsekit.functions.text import WHITESPACE
from lapsekit.operators.staging import stage_coupons
from lapsekit.sources.feeds import COUPON_SCHEMA

ids = st.sampled_from(["E1", "E2", " E2", "E3\t", None])
users = st.sampled_from(["C1", "C2", None])
dates = st.sampled_from([dt.date(2025, 1, 5), dt.date(2025, 2, 1), None])
types = st.sampled_from(["coupon_copy", " Coupon_Copy", "coupon_view", None])
rows = st.lists(st.tuples(ids, users, dates, st.sampled_from(["M1", "M2"]), types), min_size=1, max_size=25)


def _trim(x):
    return None if x is None else x.strip(WHITESPACE)


def brute_stage(raw):
    norm = [(_trim(a), _trim(b), c, _trim(d), None if e is None else _trim(e).lower()) for a, b, c, d, e in raw]
    out = []
    by_key = {}
    for r in norm:
        if r[0] is None:
            out.append((*r, 1, False, False))
        else:
            by_key.setdefault(r[0], []).append(r)
    order = lambda r: tuple((v is not None, v) for v in (r[2], r[1], r[3], r[4]))  # noqa: E731  NULLs first
    for k, rs in by_key.items():
        kept = min(rs, key=order)
        payloads = {(r[1], r[2], r[3], r[4]) for r in rs}
        out.append((*kept, len(rs), len(rs) > 1, len(payloads) > 1))
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(raw=rows)
def test_staging_matches_brute_force(spark, raw):
    df = stage_coupons(spark.createDataFrame(raw, COUPON_SCHEMA).repartition(3))
    got = sorted((tuple(r)[:8] for r in df.collect()), key=repr)
    assert got == brute_stage(raw)


def brute_transitions(active: dict, n_periods: int):
    """active: person -> set of active period indexes (1-based); all persons in the universe."""
    out = {}
    for i in range(1, n_periods):
        base = [p for p, s in active.items() if i in s]
        ret = [p for p in base if i + 1 in active[p]]
        new = [p for p, s in active.items() if i not in s and i + 1 in s]
        out[i] = (len(base), len(ret), len(base) - len(ret), len(new))
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pattern=st.dictionaries(st.sampled_from([f"U{i}" for i in range(12)]),
                               st.sets(st.integers(1, 4), max_size=4), min_size=1, max_size=12))
def test_transitions_match_brute_force(spark, pattern):
    from pyspark.sql import functions as F
    from lapsekit.operators.fact import by_definition
    from lapsekit.operators.marts import transitions
    labels = {i: f"2025Q{i}" for i in range(1, 5)}
    fact_rows = [(p, labels[i], i, i in s, i in s) for p, s in pattern.items() for i in range(1, 5)]
    fact = spark.createDataFrame(fact_rows, "unified_user_id string, quarter_label string, quarter_index long, "
                                            "is_active_baseline boolean, is_active_approved_only boolean")
    fact = fact.withColumn("quarter_start_date", F.lit(None).cast("date")) \
               .withColumn("activity_mix", F.lit("x")).withColumn("is_active_on_pending_only", F.lit(False))
    got = {r.from_quarter: (r.active_base, r.retained_users, r.churned_users, r.new_or_returning_users)
           for r in transitions(by_definition(fact)).filter("definition_name = 'baseline'").collect()}
    exp = brute_transitions(pattern, 4)
    assert got == {labels[i]: v for i, v in exp.items()}
