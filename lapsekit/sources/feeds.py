"""Raw landing contracts (S1-S3) and the multi-feed union.

Raw feeds are read into a fixed, declared, nullable schema. Only dates and the
amount are typed at load; a value that fails its cast is kept (PERMISSIVE) and
the raw line lands in ``_corrupt_record`` so it can be counted instead of lost.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsekit.functions.text import norm_code

CORRUPT = "_corrupt_record"

IDENTITY_SCHEMA = T.StructType([
    T.StructField("source_system", T.StringType()),
    T.StructField("source_user_id", T.StringType()),
    T.StructField("unified_user_id", T.StringType()),
])
COUPON_SCHEMA = T.StructType([
    T.StructField("coupon_event_id", T.StringType()),
    T.StructField("coupon_user_id", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
])
CASHBACK_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("cashback_user_id", T.StringType()),
    T.StructField("purchase_date", T.DateType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("status_updated_date", T.DateType()),
    T.StructField("amount_sar", T.DecimalType(38, 9)),
])


def _read_csv(spark: SparkSession, path, schema: T.StructType, keep_corrupt: bool) -> DataFrame:
    sch = schema
    if keep_corrupt:
        sch = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    reader = (spark.read.schema(sch).option("header", True).option("mode", "PERMISSIVE")
              .option("dateFormat", "yyyy-MM-dd"))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path)


def read_identity_map(spark: SparkSession, path, keep_corrupt: bool = False) -> DataFrame:
    """Identity map extract (source_system, source_user_id, unified_user_id)."""
    return _read_csv(spark, path, IDENTITY_SCHEMA, keep_corrupt)


def read_coupon_activity(spark: SparkSession, path, keep_corrupt: bool = False) -> DataFrame:
    """Coupon event feed, event_date typed at load."""
    return _read_csv(spark, path, COUPON_SCHEMA, keep_corrupt)


def read_cashback(spark: SparkSession, path, keep_corrupt: bool = False) -> DataFrame:
    """S3: cashback transactions of all affiliate networks in one extract."""
    return _read_csv(spark, path, CASHBACK_SCHEMA, keep_corrupt)


def load_problems(feeds: dict) -> DataFrame:
    """Check of a load: rows, and rows with a value that its declared type cannot hold, per feed
    ({name: table read with ``keep_corrupt`` and stored}): a CSV reader that is asked for few columns
    only looks at these, so the check reads the stored load."""
    parts = [df.select(F.lit(n).alias("feed"), F.col(CORRUPT).isNotNull().alias("_bad")) for n, df in feeds.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("feed").agg(
        F.count(F.lit(1)).alias("loaded_rows"), F.count_if("_bad").alias("rows_with_bad_values"))


@dataclass(frozen=True)
class FeedSpec:
    """How one affiliate network's own feed maps onto the cashback contract.

    ``columns`` maps contract column -> source column name or Column expression.
    ``status_map`` maps the network's (lower-cased, trimmed) status words to the
    contract vocabulary; words not in the map pass through unchanged so that the
    unknown-status check counts them instead of silently dropping them.
    ``timezone``: when set, ``purchase_date``/``status_updated_date`` source
    columns are UTC timestamps, converted to the calendar date in that zone.
    """

    source: str
    columns: dict = field(default_factory=dict)
    status_map: dict = field(default_factory=dict)
    timezone: str | None = None


def _status_expr(c, mapping: dict):
    c = norm_code(c)
    if not mapping:
        return c
    m = F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv])
    return F.coalesce(m[c], c)


def combine_feeds(feeds: dict) -> DataFrame:
    """Union differently shaped network feeds into the cashback contract.

    ``feeds`` = {name: (DataFrame, FeedSpec)}. One projection per feed, then
    ``unionByName``; no shuffle.
    """
    parts = []
    for name, (df, spec) in feeds.items():
        cols = {}
        for target in CASHBACK_SCHEMA.fieldNames():
            src = spec.columns.get(target, target if target in df.columns else None)
            if target == "source":
                cols[target] = F.lit(spec.source or name)
                continue
            if src is None:
                cols[target] = F.lit(None)
                continue
            c = F.col(src) if isinstance(src, str) else src
            if target in ("purchase_date", "status_updated_date"):
                if spec.timezone:
                    # UTC wall-clock -> the network's local calendar date (session-time-zone independent)
                    c = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(spec.timezone), c.cast("timestamp_ntz")))
                else:
                    c = c.cast("date")
            elif target == "status":
                c = _status_expr(c, spec.status_map)
            elif target == "amount_sar":
                c = c.cast("decimal(38,9)")
            else:
                c = c.cast("string")
            cols[target] = c
        parts.append(df.select(*[cols[t].cast(f.dataType).alias(t) for t, f in
                                 zip(CASHBACK_SCHEMA.fieldNames(), CASHBACK_SCHEMA.fields)]))
    return reduce(lambda a, b: a.unionByName(b), parts)
