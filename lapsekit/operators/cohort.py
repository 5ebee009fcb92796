"""Layer 5: anchor cohort, confirmed churn and reactivation.

The cohort is parameterised: ``anchor`` is the 1-based period index of the
cohort, ``n_silent`` the number of silent periods that confirm churn (2 = silent
in both of the next two periods). Column names follow the anchor (``active_q1``,
``q1_cohort_status``, ``retained_in_q2`` ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsekit.functions.periods import periods_of
from lapsekit.functions.rates import rate
from lapsekit.spec import ChurnSpec, DEFAULT_SPEC


def _n_periods(spec: ChurnSpec) -> int:
    return len(periods_of(spec.period_start, spec.period_end, spec.grain))


def _observed(spec: ChurnSpec):
    """(flag of period i, NULL where the period lies beyond the range; any later activity; enough silent
    periods observed to confirm churn)."""
    P, a, n = _n_periods(spec), spec.cohort_anchor, spec.n_silent
    act = lambda i: F.col(f"active_q{i}") if 1 <= i <= P else F.lit(None).cast("boolean")
    later = F.lit(False)
    for i in range(a + 2, min(a + n, P) + 1):
        later = later | act(i)
    return act, later, a + n <= P


def cohort_users(long: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Per definition x person: active flag per period, activity pattern
    ('1011') and cohort status. One hash aggregate on (definition, person). A status
    that rests on periods beyond the range is ``not_yet_observed``: what has not
    happened yet is not silence."""
    P, a, n = _n_periods(spec), spec.cohort_anchor, spec.n_silent
    flags = [F.coalesce(F.bool_or(F.col("is_active") & (F.col("quarter_index") == i)), F.lit(False))
             .alias(f"active_q{i}") for i in range(1, P + 1)]
    piv = long.groupBy("definition_name", "unified_user_id").agg(*flags)
    act, any_later, settled = _observed(spec)
    pattern = F.concat(*[F.when(act(i), "1").otherwise("0") for i in range(1, P + 1)])
    status = (F.when(~act(a), f"not_in_q{a}_cohort")
              .when(act(a + 1), f"retained_in_q{a + 1}")
              .when(act(a + 1).isNull(), "not_yet_observed")
              .when(any_later, f"lapsed_q{a + 1}_reactivated_q{a + 2}" if n == 2
                    else f"lapsed_q{a + 1}_reactivated")
              .otherwise("confirmed_churn" if settled else "not_yet_observed"))
    return piv.select("definition_name", "unified_user_id", *[f"active_q{i}" for i in range(1, P + 1)],
                      pattern.alias("activity_pattern"), status.alias(f"q{a}_cohort_status"))


def cohort_summary(users: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Cohort size, retained, lapsed, confirmed churn, reactivation and rates. Counts that rest
    on periods beyond the range are NULL, and so are their rates."""
    P, a, n = _n_periods(spec), spec.cohort_anchor, spec.n_silent
    act, any_later, settled = _observed(spec)
    coh, nxt = act(a), act(a + 1)
    r = f"q{a + 2}" if n == 2 else "later"

    def count(cond, known: bool):
        return F.count_if(cond) if known else F.lit(None).cast("long")

    agg = users.groupBy("definition_name").agg(
        F.count_if(coh).alias(f"q{a}_cohort_users"),
        count(coh & nxt, a < P).alias(f"retained_in_q{a + 1}"),
        count(coh & ~nxt, a < P).alias(f"lapsed_in_q{a + 1}"),
        count(coh & ~nxt & ~any_later, settled).alias("confirmed_churn_users"),
        count(coh & ~nxt & any_later, settled).alias(f"reactivated_in_{r}_users"),
    )
    return cohort_rates(agg, spec)


def cohort_rates(counts: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """The counts of M13 with their rates."""
    a, n = spec.cohort_anchor, spec.n_silent
    r = f"q{a + 2}" if n == 2 else "later"
    return counts.select(
        "definition_name", f"q{a}_cohort_users", f"retained_in_q{a + 1}", f"lapsed_in_q{a + 1}",
        "confirmed_churn_users",
        rate("confirmed_churn_users", f"q{a}_cohort_users").alias("confirmed_churn_rate_of_cohort"),
        f"reactivated_in_{r}_users",
        rate(f"reactivated_in_{r}_users", f"lapsed_in_q{a + 1}").alias(f"reactivation_rate_of_lapsed_q{a + 1}"),
        rate(f"reactivated_in_{r}_users", f"q{a}_cohort_users").alias("reactivated_share_of_cohort"),
        rate(f"lapsed_in_q{a + 1}", f"q{a}_cohort_users").alias(f"single_quarter_churn_rate_q{a}_q{a + 1}"),
    )
