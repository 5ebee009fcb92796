"""Identity on two time axes (E12): when a mapping holds, and when it was known.

A bitemporal map has (source_system, source_user_id, unified_user_id, valid_from, valid_to,
known_from, known_to), all dates inclusive, NULL for open. A merge that is entered on one day
but holds from the start restates history: ``known_at`` gives the map as it stood on a day, and
``activity_as_known`` the as-of activity (M20) of one reporting date under that map. The two
dates are independent: what had happened by ``as_of``, as identities were known on ``known``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsekit.operators.asof import activity_as_of
from lapsekit.operators.events import unify_events
from lapsekit.operators.extensions import disjoint_identity
from lapsekit.spec import ChurnSpec, DEFAULT_SPEC


def known_at(bitemporal: DataFrame, known: dt.date) -> DataFrame:
    """The type-2 map as it was known on a day: entered by then, and not yet withdrawn."""
    day = F.lit(known)
    entered = F.coalesce(F.col("known_from") <= day, F.lit(True))
    standing = F.coalesce(F.col("known_to") >= day, F.lit(True))
    return bitemporal.filter(entered & standing).drop("known_from", "known_to")


def activity_as_known(coupons: DataFrame, cashback: DataFrame, bitemporal: DataFrame, as_of: dt.date, known: dt.date,
                      spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """M20 for ``as_of`` with the identity map as known on ``known``."""
    events = unify_events(coupons, cashback, disjoint_identity(known_at(bitemporal, known)), spec)
    return activity_as_of(events, as_of, spec).withColumn("known_date", F.lit(known))


def identity_restatement(coupons: DataFrame, cashback: DataFrame, bitemporal: DataFrame, as_of: dt.date, before: dt.date,
                         after: dt.date, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Does a merge restate history? Per period and definition, the active persons of one reporting date under the
    maps known on two days, and how many persons are active under one of them only."""
    sides = {n: activity_as_known(coupons, cashback, bitemporal, as_of, k, spec) for n, k in (("before", before), ("after", after))}
    rows = None
    for name, df in sides.items():
        flags = F.array(*[F.struct(F.lit(d.name).alias("definition_name"), F.col(f"is_active_{d.name}").alias("on"))
                          for d in spec.definitions])
        one = (df.select("unified_user_id", "quarter_label", F.inline(flags)).filter("on")
               .select("definition_name", "quarter_label", "unified_user_id", F.lit(name == "before").alias("_b")))
        rows = one if rows is None else rows.unionByName(one)
    person = rows.groupBy("definition_name", "quarter_label", "unified_user_id").agg(
        F.bool_or("_b").alias("b"), F.bool_or(~F.col("_b")).alias("a"))
    return person.groupBy("definition_name", "quarter_label").agg(
        F.count_if("b").alias("active_as_known_before"), F.count_if("a").alias("active_as_known_after"),
        F.count_if(F.col("b") & ~F.col("a")).alias("persons_gone"), F.count_if(~F.col("b") & F.col("a")).alias("persons_new"))
