"""Sources and sinks: feed readers (S1-S4), the driver-table adapter, materialisation (S5), export."""

from lapsekit.sources.feeds import (
    IDENTITY_SCHEMA, COUPON_SCHEMA, CASHBACK_SCHEMA,
    read_identity_map, read_coupon_activity, load_problems, read_cashback,
    FeedSpec, combine_feeds,
)
from lapsekit.sources.adapter import RawInputs, adapter_inputs, csv_inputs
from lapsekit.sources.sinks import materialise, export_summary, scratch_dir

__all__ = [
    "IDENTITY_SCHEMA", "COUPON_SCHEMA", "CASHBACK_SCHEMA", "read_identity_map",
    "read_coupon_activity", "read_cashback", "load_problems", "FeedSpec", "combine_feeds",
    "RawInputs", "adapter_inputs", "csv_inputs", "materialise", "export_summary", "scratch_dir",
]
