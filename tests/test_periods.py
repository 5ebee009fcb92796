"""Period arithmetic: Spark expressions agree with the parameter-side period list,
and coarser grains are the OR of finer ones."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lapsekit.functions.periods import period_end, period_index, period_label, period_start, periods_of

START = dt.date(2024, 12, 30)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.lists(st.integers(0, 800), min_size=5, max_size=40))
def test_expressions_match_period_list(spark, days):
    dates = [START + dt.timedelta(days=d) for d in days]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    for grain in ("quarter", "month", "week"):
        ps = periods_of(START, START + dt.timedelta(days=800), grain)
        first = ps[0].start
        got = df.select("d", period_label("d", grain).alias("l"), period_start("d", grain).alias("s"),
                        period_end(period_start("d", grain), grain).alias("e"),
                        period_index("d", first, grain).alias("i")).collect()
        for r in got:
            p = ps[r.i - 1]
            assert (p.label, p.start, p.end) == (r.l, r.s, r.e) and p.start <= r.d <= p.end


def test_month_grain_rolls_up_to_quarters(spark, golden):
    from lapsekit.plans.layers import Layers
    monthly = Layers(golden.raw, golden.spec.with_(grain="month"))
    assert monthly.fact.count() == 66 * 12
    m = (monthly.fact.withColumn("q", F.concat(F.lit("2025Q"), F.ceil(F.col("quarter_index") / 3).cast("string")))
         .groupBy("unified_user_id", "q").agg(F.bool_or("is_active_baseline").alias("a")))
    q = golden.fact.select("unified_user_id", F.col("quarter_label").alias("q"), F.col("is_active_baseline").alias("a"))
    assert m.exceptAll(q).count() == 0 and q.exceptAll(m).count() == 0
    t = {r.from_quarter: r.active_base for r in monthly.transitions.filter("definition_name = 'baseline'").collect()}
    assert len(t) == 11 and t["2025-02"] > 0
