"""Layer 10b: build audit, row-count drift / freshness monitor (M28) and the
cardinality ledger (M29)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType([
    T.StructField("object_name", T.StringType()), T.StructField("row_count", T.LongType()),
    T.StructField("size_bytes", T.LongType()), T.StructField("last_built_at", T.TimestampType()),
])


def table_audit(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Audit of written tables {name: parquet path}: row count, bytes on disk and
    last write time, read from the files' own metadata (``_metadata``)."""
    parts = []
    for name, path in tables.items():
        # only the files' metadata is read; the schema is given so an empty table audits as 0 rows. A file's
        # size is counted at its first row, so rows need not be grouped by file
        df = spark.read.schema("_audit_unused int").parquet(path).select(
            "_metadata.row_index", "_metadata.file_size", "_metadata.file_modification_time")
        size = F.sum(F.when(F.col("row_index") == 0, F.col("file_size")))
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(size, F.lit(0)).alias("size_bytes"),
                            F.max("file_modification_time").alias("last_built_at"))
                     .select(F.lit(name).alias("object_name"), "row_count", "size_bytes", "last_built_at"))
    if not parts:
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


# --- fixed values: layer of an object, by name prefix ---------------------
LAYER_PREFIXES = [("raw_", "L0 raw"), ("dim_", "L4 dimension"), ("stg_", "L1 staging"), ("int_", "L2 unified"),
                  ("fct_", "L3 fact"), ("mart_", "L4 mart"), ("dq_", "Quality")]
# ---------------------------------------------------------------------------


def row_count_monitor(audit: DataFrame, expected: DataFrame) -> DataFrame:
    """Every built or expected object with its drift and freshness.

    ``expected``: (object_name, expected_rows). Full outer join, so an expected
    object that was not built shows as MISSING and an unexpected one as NOT TRACKED."""
    a, e = audit.alias("a"), expected.alias("e")
    j = a.join(e, F.col("a.object_name") == F.col("e.object_name"), "full_outer")
    name = F.coalesce(F.col("a.object_name"), F.col("e.object_name"))
    layer = None
    for p, lab in LAYER_PREFIXES:
        layer = F.when(name.startswith(p), lab) if layer is None else layer.when(name.startswith(p), lab)
    layer = layer.otherwise("other")
    rc, ex = F.col("a.row_count"), F.col("e.expected_rows").cast("long")
    status = (F.when(F.col("a.object_name").isNull(), "MISSING").when(ex.isNull(), "NOT TRACKED")
              .when(rc == ex, "OK").otherwise("DRIFT"))
    return j.select(layer.alias("layer"), name.alias("object_name"), rc.alias("row_count"), ex.alias("expected_rows"),
                    (rc - ex).alias("row_count_drift"), status.alias("row_count_status"),
                    F.col("a.last_built_at").alias("last_built_at"),
                    F.timestamp_diff("HOUR", F.col("a.last_built_at"), F.current_timestamp()).alias("hours_since_build"),
                    F.col("a.size_bytes").alias("size_bytes"))


def cardinality_ledger(layers) -> DataFrame:
    """Rows in / out of each pipeline step, computed live: one count per
    table, unioned and folded into one row (a single job), then stacked."""
    raw, L = layers.raw, layers
    tables = {"raw_c": raw.coupons, "stg_c": L.stg_coupons, "raw_b": raw.cashback, "stg_b": L.stg_cashback,
              "raw_i": raw.identity, "stg_i": L.stg_identity, "fct": L.fact}
    counts = [df.agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("n")) for k, df in tables.items()]
    counts.append(L.events.agg(F.lit("ev").alias("k"), F.count(F.lit(1)).alias("n")))
    counts.append(L.events.agg(F.lit("scope").alias("k"), F.count_if(F.col("is_in_scope")).alias("n")))
    allc = reduce(DataFrame.unionByName, counts)
    base = allc.agg(*[F.max(F.when(F.col("k") == k, F.col("n"))).alias(k)
                      for k in list(tables) + ["ev", "scope"]])
    steps = [
        (1, "Coupon: raw -> staging", F.col("raw_c"), F.col("stg_c"), "Duplicate coupon_event_id rows collapsed"),
        (2, "Cashback: raw -> staging", F.col("raw_b"), F.col("stg_b"), "Duplicate transaction_id rows collapsed"),
        (3, "Identity map: raw -> staging", F.col("raw_i"), F.col("stg_i"), "One row per source_system + source_user_id"),
        (4, "Staging -> unified events", F.col("stg_c") + F.col("stg_b"), F.col("ev"),
         "Union of both channels; adds and loses nothing"),
        (5, "Unified -> in scope", F.col("ev"), F.col("scope"), "Unmapped, ambiguous or out-of-period events excluded"),
        (6, "In scope -> fact", F.col("scope"), F.col("fct"), "Densification, not a filter: people x quarters"),
    ]
    parts = [x for o, s, i, out, ex in steps for x in (F.lit(o), F.lit(s), i.cast("long"), out.cast("long"), F.lit(ex))]
    long = base.select(F.stack(F.lit(len(steps)), *parts).alias("step_order", "step", "rows_in", "rows_out", "explanation"))
    return long.select("step_order", "step", "rows_in", "rows_out", (F.col("rows_out") - F.col("rows_in")).alias("row_delta"),
                       "explanation")


def expected_row_counts(layers) -> DataFrame:
    """The model's own arithmetic for every object of a build: raw = rows loaded; staging = one row
    per business key (+ one per row without a key), read from the keys' counters; events = both
    staged feeds; fact and marts = products of persons, periods, definitions, networks and lags;
    checks = the size of the check catalogue. Figures that depend on the data are counted on
    the layers with one aggregate each, none of them a distinct count over raw rows."""
    from lapsekit.functions.periods import periods_of
    from lapsekit.operators.marts import cut_periods
    from lapsekit.operators.quality import CHECKS
    raw, spec, L = layers.raw, layers.spec, layers
    ps = periods_of(spec.period_start, spec.period_end, spec.grain)
    n_def, n_per = len(spec.definitions), len(ps)
    steps = sum(not {p.label, x.label} & set(cut_periods(spec)) for p, x in zip(ps, ps[1:]))
    one = F.count(F.lit(1))

    def count(df: DataFrame, c=one):
        return df.agg(c.cast("long").alias("n"))

    # copies beyond the first are what staging removes: the loaded rows less the copies are the keys
    kept = lambda staged, loaded: count(staged, F.sum(F.lit(1)) + F.lit(loaded) - F.sum("raw_row_count"))
    n_raw = {k: count(df).first()[0] for k, df in (("identity", raw.identity), ("coupons", raw.coupons), ("cashback", raw.cashback))}
    persons = count(L.stg_identity.filter(~F.col("has_ambiguous_mapping") & F.col("unified_user_id").isNotNull())
                    .select("unified_user_id").distinct()).first()[0]
    staged = {"coupons": kept(L.stg_coupons, n_raw["coupons"]).first()[0] or 0,
              "cashback": kept(L.stg_cashback, n_raw["cashback"]).first()[0] or 0}
    from lapsekit.functions.text import norm_code, norm_key
    s, i = norm_code("source_system"), norm_key("source_user_id")
    whole = s.isNotNull() & i.isNotNull()
    idents = count(raw.identity.select(s.alias("s"), i.alias("i"), whole.alias("w"),
                                       F.when(~whole, F.monotonically_increasing_id()).alias("u")).distinct()).first()[0]
    decided = L.stg_cashback.filter("status_updated_date IS NOT NULL")
    networks = count(decided.select("source").distinct()).first()[0]
    disagree = count(L.fact.filter("is_active_on_pending_only")).first()[0]
    first = F.min(F.trunc("purchase_date", "quarter" if spec.grain == "quarter" else spec.grain))
    spans = L.stg_cashback.groupBy("source").agg(first.alias("a"), F.max(F.trunc("purchase_date", "quarter" if spec.grain == "quarter"
                                                                               else spec.grain)).alias("z"),
                                                 F.max(F.col("purchase_date").isNull()).alias("undated"))
    months = {"quarter": 3, "month": 1}.get(spec.grain)
    last = spans.agg(F.max("z")).first()[0]
    length = (F.floor(F.months_between(F.lit(last), "a") / months) if months else F.floor(F.datediff(F.lit(last), "a") / 7)) + 1
    profile = spans.agg(F.sum(F.coalesce(length, F.lit(0)) + F.col("undated").cast("long")).cast("long")).first()[0] or 0
    suspects = count(L.cross_source_duplicates).first()[0]
    report = 5 * n_def * n_per + 5 * n_def * steps + 7 * n_def + 5 * n_per
    rows = {
        "raw_identity_map": n_raw["identity"], "raw_coupon_activity": n_raw["coupons"],
        "raw_cashback_transactions": n_raw["cashback"], "dim_quarter": n_per, "stg_identity_map": idents,
        "stg_coupon_events": staged["coupons"], "stg_cashback_transactions": staged["cashback"],
        "int_unified_activity_events": staged["coupons"] + staged["cashback"],
        "fct_user_quarter_activity": persons * n_per, "mart_quarterly_active_base": n_def * n_per,
        "mart_quarter_transitions": n_def * steps, "mart_definition_sensitivity": steps,
        "mart_definition_disagreements": disagree, "mart_q1_cohort_users": n_def * persons,
        "mart_q1_cohort_summary": n_def, "mart_cashback_source_profile": profile,
        "dq_cross_source_duplicate_suspects": suspects, "mart_pending_exposure": n_per,
        "mart_cashback_approval_maturity": networks + 1, "mart_churn_vintage_comparison": n_def * len(spec.vintage_lags),
        "mart_report_summary": report, "dq_check_results": len(CHECKS),
    }
    return layers.spark.createDataFrame(sorted(rows.items()), "object_name string, expected_rows long")


def model_audit(layers) -> DataFrame:
    """Row counts of the model's stored objects: from the written files' metadata
    when the layers are stored, else by counting the (lazy) objects."""
    objs = {"stg_identity_map": layers.stg_identity, "stg_coupon_events": layers.stg_coupons,
            "stg_cashback_transactions": layers.stg_cashback, "int_unified_activity_events": layers.events,
            "fct_user_quarter_activity": layers.fact, "dq_check_results": layers.dq_checks(with_checked_at=False)}
    if layers.materialise and layers._location:
        import os
        return table_audit(layers.spark, {n: os.path.join(layers._location, n) for n in objs})
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
        F.lit(n).alias("object_name"), "row_count", F.lit(None).cast("long").alias("size_bytes"),
        F.lit(None).cast("timestamp").alias("last_built_at")) for n, df in objs.items()]
    return reduce(DataFrame.unionByName, parts)
