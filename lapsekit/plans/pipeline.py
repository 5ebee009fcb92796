"""Build the whole model into a target folder, in dependency order.

``run_pipeline`` lands the raw feeds (unless ``skip_load``), writes the stored
layers (staging and events month-partitioned, fact clustered by person) and
every mart, then returns the written tables plus a build audit and the
row-count monitor. The publish gate stands between the layers and the marts: an
error-graded check that fails stops the build there, unless ``allow_blocked``. ``target`` is any path the cluster shares (an isolated copy
is just another target); every table is written with overwrite, so a re-run
is idempotent.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsekit.plans.layers import Layers
from lapsekit.sources.adapter import RawInputs
from lapsekit.sources.sinks import materialise
from lapsekit.spec import ChurnSpec, DEFAULT_SPEC

MARTS = [
    ("dim_quarter", "spine"),
    ("mart_quarterly_active_base", "active_base"),
    ("mart_quarter_transitions", "transitions"),
    ("mart_definition_sensitivity", "sensitivity"),
    ("mart_definition_disagreements", "disagreements"),
    ("mart_q1_cohort_users", "cohort_users"),
    ("mart_q1_cohort_summary", "cohort_summary"),
    ("mart_cashback_source_profile", "source_profile"),
    ("dq_cross_source_duplicate_suspects", "cross_source_duplicates"),
    ("mart_pending_exposure", "pending_exposure"),
    ("mart_cashback_approval_maturity", "approval_maturity"),
    ("mart_churn_vintage_comparison", "transition_by_vintage"),
    ("mart_report_summary", "report_summary"),
]


def run_pipeline(spark: SparkSession, inputs: RawInputs | None, target: str, *, skip_load: bool = False,
                 spec: ChurnSpec = DEFAULT_SPEC, expected: dict | DataFrame | None = None,
                 allow_blocked: bool = False) -> dict[str, DataFrame]:
    p = lambda name: os.path.join(target, name)
    if skip_load:
        raw = RawInputs(spark.read.parquet(p("raw_identity_map")), spark.read.parquet(p("raw_coupon_activity")),
                        spark.read.parquet(p("raw_cashback_transactions")))
    else:
        raw = RawInputs(materialise(inputs.identity, p("raw_identity_map")),
                        materialise(inputs.coupons, p("raw_coupon_activity")),
                        materialise(inputs.cashback, p("raw_cashback_transactions")))
    L = Layers(raw, spec, materialise=True, location=target)
    out: dict[str, DataFrame] = {
        "raw_identity_map": raw.identity, "raw_coupon_activity": raw.coupons,
        "raw_cashback_transactions": raw.cashback,
        "stg_identity_map": L.stg_identity, "stg_coupon_events": L.stg_coupons,
        "stg_cashback_transactions": L.stg_cashback, "int_unified_activity_events": L.events,
        "fct_user_quarter_activity": L.fact,
    }
    out["dq_check_results"] = L.dq_check_results            # stored by the layers at target/dq_check_results
    if not allow_blocked:                                   # no mart is written from a build that fails the gate
        publish_or_raise(L.dq_checks(with_checked_at=False))
    for name, attr in MARTS:
        out[name] = materialise(getattr(L, attr), p(name))
    from lapsekit.operators.monitoring import row_count_monitor, table_audit
    audit = table_audit(spark, {n: p(n) for n in out})
    out["build_audit"] = audit
    if expected is not None:
        exp = (spark.createDataFrame(sorted(expected.items()), "object_name string, expected_rows long")
               if isinstance(expected, dict) else expected)
        out["v_pipeline_row_counts"] = row_count_monitor(audit, exp)
    out["layers"] = L  # type: ignore[assignment]
    return out


def publish_or_raise(dq: DataFrame) -> None:
    """Gate: raise when an error-graded check fails (the job stops before publishing)."""
    from lapsekit.operators.quality import publish_gate
    publish_gate(dq, raise_on_block=True).select(F.col("can_publish")).collect()
