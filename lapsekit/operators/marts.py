"""Layer 4: active base, transitions, definition sensitivity, disagreements."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapsekit.functions.rates import rate
from lapsekit.spec import ChurnSpec, DEFAULT_SPEC


def active_base(long: DataFrame) -> DataFrame:
    """Active users per definition x period, with channel mix."""
    a = F.col("is_active")
    mix = F.col("activity_mix")
    return long.groupBy("definition_name", "quarter_label", "quarter_index").agg(
        F.count_if(a).alias("active_users"),
        F.count_if(a & (mix == "coupon_only")).alias("active_coupon_only"),
        F.count_if(a & (mix == "cashback_only")).alias("active_cashback_only"),
        F.count_if(a & (mix == "both")).alias("active_both_channels"),
        F.count_if(a & F.col("is_active_on_pending_only")).alias("active_on_pending_only"),
        F.count(F.lit(1)).alias("users_in_universe"),
    )


def user_timeline(long: DataFrame) -> DataFrame:
    """Each dense row with the person's next period (``lead`` over a window whose
    partitions hold exactly one row per period, so no partition can be skewed)."""
    w = Window.partitionBy("definition_name", "unified_user_id").orderBy("quarter_index")
    return long.select(
        "definition_name", "unified_user_id", "quarter_label", "quarter_index", "is_active",
        F.lead("is_active").over(w).alias("is_active_next_quarter"),
        F.lead("quarter_label").over(w).alias("next_quarter_label"),
    )


def cut_periods(spec: ChurnSpec) -> list[str]:
    """Labels of periods that lie only partly in the analysis range (the first or the last)."""
    from lapsekit.functions.periods import periods_of
    return [p.label for p in periods_of(spec.period_start, spec.period_end, spec.grain) if not p.complete]


def transitions(long: DataFrame, spec: ChurnSpec | None = None) -> DataFrame:
    """Period-to-period base, retained, churned, rates, new-or-returning. With ``spec``,
    transitions from or to a period that the analysis range cuts off are left out: a
    shorter period has fewer active people for that reason alone."""
    a, n = F.col("is_active"), F.col("is_active_next_quarter")
    steps = user_timeline(long).filter(F.col("next_quarter_label").isNotNull())
    if spec is not None and (cut := cut_periods(spec)):
        steps = steps.filter(~F.col("quarter_label").isin(*cut) & ~F.col("next_quarter_label").isin(*cut))
    agg = (steps
           .groupBy("definition_name", F.col("quarter_label").alias("from_quarter"),
                    F.col("next_quarter_label").alias("to_quarter"))
           .agg(F.count_if(a).alias("active_base"),
                F.count_if(a & n).alias("retained_users"),
                F.count_if(a & ~n).alias("churned_users"),
                F.count_if(~a & n).alias("new_or_returning_users")))
    return agg.select(
        "definition_name", "from_quarter", "to_quarter", "active_base", "retained_users", "churned_users",
        rate("churned_users", "active_base").alias("next_quarter_churn_rate"),
        rate("retained_users", "active_base").alias("next_quarter_retention_rate"),
        "new_or_returning_users")


def definition_sensitivity(trans: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """Broad vs strict definition side by side; deltas of the rounded rates.

    One conditional aggregate over the transitions (keyed by transition), so
    the transitions are computed once instead of being joined to themselves."""
    b_name, a_name = spec.primary.name, spec.strict.name
    d = F.col("definition_name")
    pick = lambda name, c: F.max(F.when(d == name, F.col(c)))
    g = trans.groupBy("from_quarter", "to_quarter").agg(
        pick(b_name, "active_base").alias(f"{b_name}_active_base"),
        pick(a_name, "active_base").alias(f"{a_name}_active_base"),
        pick(b_name, "churned_users").alias(f"{b_name}_churned"),
        pick(a_name, "churned_users").alias(f"{a_name}_churned"),
        pick(b_name, "next_quarter_churn_rate").alias(f"{b_name}_churn_rate"),
        pick(a_name, "next_quarter_churn_rate").alias(f"{a_name}_churn_rate"))
    g = g.filter(F.col(f"{b_name}_active_base").isNotNull() & F.col(f"{a_name}_active_base").isNotNull())
    return g.select(
        "from_quarter", "to_quarter", f"{b_name}_active_base", f"{a_name}_active_base",
        (F.col(f"{a_name}_active_base") - F.col(f"{b_name}_active_base")).alias("active_base_delta"),
        f"{b_name}_churned", f"{a_name}_churned",
        (F.col(f"{a_name}_churned") - F.col(f"{b_name}_churned")).alias("churned_delta"),
        f"{b_name}_churn_rate", f"{a_name}_churn_rate",
        F.round(F.col(f"{a_name}_churn_rate") - F.col(f"{b_name}_churn_rate"), 4).alias("churn_rate_delta_pp"),
    )


def definition_disagreements(fact: DataFrame) -> DataFrame:
    """Person-periods active only because a pending transaction counts."""
    return fact.filter(F.col("is_active_on_pending_only")).select(
        "unified_user_id", "quarter_label", "quarter_index", "cashback_pending_transactions",
        "pending_amount_sar",
        F.lit("active under baseline, inactive under approved_only").alias("disagreement"))


MASK = 62  # periods a mask steps over: bit 62 of one mask is bit 0 of the next


def transitions_by_bitmap(fact: DataFrame, spec: ChurnSpec = DEFAULT_SPEC) -> DataFrame:
    """M09 without a window: one hash aggregate per person folds the activity of
    every period into bit masks per definition (``bit_or`` of ``1 << (index-1)``,
    fixed-width buffers, so map-side combine applies), then each transition is a
    bit test and the counts are a tiny second aggregate. Same result as
    :func:`transitions`; suited to a fact that is not stored by person. Longer ranges
    take several masks, which overlap by one period."""
    from lapsekit.functions.periods import periods_of
    from lapsekit.operators.fact import active_col
    ps = periods_of(spec.period_start, spec.period_end, spec.grain)
    n_masks = -(-max(len(ps) - 1, 1) // MASK)
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")

    def bit(m: int):
        at = F.col("quarter_index") - 1 - m * MASK
        power = F.call_function("shiftleft", one, at.cast("int"))
        return F.when((at >= 0) & (at <= MASK), power).otherwise(zero)

    masks = fact.groupBy("unified_user_id").agg(*[
        F.bit_or(F.when(F.col(active_col(d)), bit(m)).otherwise(zero)).alias(f"{d.name}_{m}")
        for d in spec.definitions for m in range(n_masks)])
    per_def = masks.select(F.inline(F.array(*[
        F.struct(F.lit(d.name).alias("definition_name"), F.array(*[F.col(f"{d.name}_{m}") for m in range(n_masks)])
                 .alias("masks")) for d in spec.definitions])))
    cut = set(cut_periods(spec))
    from_to = [p.index for p, x in zip(ps, ps[1:]) if not {p.label, x.label} & cut]
    steps = per_def.select("definition_name", "masks",
                           F.explode(F.array(*[F.lit(i) for i in from_to]).cast("array<int>")).alias("i"))
    bits = F.get("masks", F.floor((F.col("i") - 1) / MASK).cast("int"))
    on = lambda k: F.call_function("shiftright", bits, ((F.col("i") - 1) % MASK + k).cast("int")).bitwiseAND(one) == 1
    a, n = on(0), on(1)
    agg = steps.groupBy("definition_name", "i").agg(
        F.count_if(a).alias("active_base"), F.count_if(a & n).alias("retained_users"),
        F.count_if(a & ~n).alias("churned_users"), F.count_if(~a & n).alias("new_or_returning_users"))
    lab = F.create_map(*[F.lit(x) for p in ps for x in (p.index, p.label)])
    return agg.select(
        "definition_name", lab[F.col("i")].alias("from_quarter"), lab[F.col("i") + 1].alias("to_quarter"),
        "active_base", "retained_users", "churned_users",
        rate("churned_users", "active_base").alias("next_quarter_churn_rate"),
        rate("retained_users", "active_base").alias("next_quarter_retention_rate"),
        "new_or_returning_users")
