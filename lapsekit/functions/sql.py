"""The model in Spark SQL: scalar functions of periods, and table functions over a build's layers.

``register`` creates temporary functions and views in the session, so that a user can write

    SELECT period_label(activity_date), count(*) FROM churn_events GROUP BY 1
    SELECT * FROM activity_as_of(DATE '1996-09-30')

They are SQL functions: the optimizer puts their bodies into the query, and filters on their
result reach the stored events' month folders.
"""

from __future__ import annotations

from lapsekit.operators.events import activity_col
from lapsekit.plans.layers import Layers
from lapsekit.spec import COUPON, PENDING, ChurnSpec

_START = {"quarter": "trunc(d, 'QUARTER')", "month": "trunc(d, 'MONTH')", "week": "trunc(d, 'WEEK')"}
_LABEL = {"quarter": "concat(year(d), 'Q', quarter(d))", "month": "date_format(d, 'yyyy-MM')",
          "week": "date_format(trunc(d, 'WEEK'), 'yyyy-MM-dd')"}
_END = {"quarter": "date_sub(add_months(trunc(d, 'QUARTER'), 3), 1)", "month": "last_day(d)", "week": "date_add(trunc(d, 'WEEK'), 6)"}


def _words(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def function_texts(spec: ChurnSpec) -> dict[str, str]:
    """{name: CREATE statement}."""
    def one(name: str, signature: str, body: str) -> str:
        return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{signature} RETURN {body}"

    g = spec.grain
    status = f"CASE WHEN status_updated_date IS NULL OR status_updated_date > as_of THEN '{PENDING}' ELSE event_or_status END"
    counts = [f"coalesce(CASE WHEN channel = '{COUPON}' THEN {activity_col(d)} ELSE {status} IN ({_words(d.cashback_statuses)}) "
              f"END, false) AS c_{d.name}" for d in spec.definitions]
    active = [f"bool_or(c_{d.name}) AS is_active_{d.name}" for d in spec.definitions]
    returns = ", ".join(f"is_active_{d.name} BOOLEAN" for d in spec.definitions)
    last = max(spec.period_start, spec.period_end)
    return {
        "period_start": one("period_start", "(d DATE) RETURNS DATE", _START[g]),
        "period_end": one("period_end", "(d DATE) RETURNS DATE", _END[g]),
        "period_label": one("period_label", "(d DATE) RETURNS STRING", _LABEL[g]),
        "in_analysis_period": one("in_analysis_period", "(d DATE) RETURNS BOOLEAN",
                                  f"coalesce(d BETWEEN DATE '{spec.period_start}' AND DATE '{last}', false)"),
        "status_as_of": one("status_as_of", "(status STRING, decided DATE, as_of DATE) RETURNS STRING",
                            f"CASE WHEN decided IS NULL OR decided > as_of THEN '{PENDING}' ELSE status END"),
        "activity_as_of": one(
            "activity_as_of",
            f"(as_of DATE) RETURNS TABLE (as_of_date DATE, unified_user_id STRING, quarter_label STRING, {returns})",
            f"SELECT as_of_date, unified_user_id, quarter_label, {', '.join(active)} FROM ("
            f"SELECT as_of AS as_of_date, unified_user_id, quarter_label, {', '.join(counts)} FROM churn_events "
            "WHERE is_in_scope AND unified_user_id IS NOT NULL AND activity_date <= as_of) "
            "GROUP BY as_of_date, unified_user_id, quarter_label"),
    }


def register(layers: Layers) -> list[str]:
    """Create the functions and the view ``churn_events`` (the events of the analysis range) in the session of
    ``layers``; the functions' names."""
    spark = layers.spark
    layers.period_events.createOrReplaceTempView("churn_events")
    layers.fact.createOrReplaceTempView("churn_fact")
    texts = function_texts(layers.spec)
    for text in texts.values():
        spark.sql(text)
    return list(texts)
