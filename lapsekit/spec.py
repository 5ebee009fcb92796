"""Parameters of an activity / churn build.

Everything the SQL of a warehouse pipeline would hard-code (analysis period,
period grain, definitions, vocabularies, horizons, vintage lags, cohort anchor)
is an argument here, so one code path serves every reporting setup.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Definition:
    """An activity definition: which cashback statuses count as activity.

    Coupon activity always counts when the event type is eligible.
    """

    name: str
    cashback_statuses: tuple[str, ...]


# --- fixed values: business vocabulary of the feeds -------------------------
COUPON = "coupon"
CASHBACK = "cashback"
SOURCE_SYSTEMS = ("coupon", "cashback")
ELIGIBLE_EVENT_TYPES = ("coupon_copy",)
# status -> status_class
STATUS_CLASSES = (
    ("approved", "settled"),
    ("pending", "in_flight"),
    ("rejected", "failed"),
    ("cancelled", "failed"),
)
UNKNOWN_STATUS_CLASS = "unknown"
APPROVED = "approved"
PENDING = "pending"
EXCLUDED_STATUSES = ("rejected", "cancelled")
COUPON_FEED_NAME = "coupon_copy_event"
ALL_SOURCES_LABEL = "ALL SOURCES"
BASELINE = Definition("baseline", ("approved", "pending"))
APPROVED_ONLY = Definition("approved_only", ("approved",))
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class ChurnSpec:
    """All knobs of the pipeline.

    ``period_start`` / ``period_end`` bound the analysis period (inclusive).
    ``grain`` is ``quarter`` (default), ``month`` or ``week``; output columns keep
    the ``quarter_*`` names whatever the grain.
    ``definitions[0]`` is the broad (primary) definition, ``definitions[1]`` the
    strict one; ``is_active_on_pending_only`` = broad and not strict.
    """

    period_start: dt.date = dt.date(2025, 1, 1)
    period_end: dt.date = dt.date(2025, 12, 31)
    grain: str = "quarter"
    definitions: tuple[Definition, ...] = (BASELINE, APPROVED_ONLY)
    source_systems: tuple[str, ...] = SOURCE_SYSTEMS
    eligible_event_types: tuple[str, ...] = ELIGIBLE_EVENT_TYPES
    status_classes: tuple[tuple[str, str], ...] = STATUS_CLASSES
    horizons: tuple[int, ...] = (30, 45, 60, 90)
    vintage_lags: tuple[int, ...] = (0, 30, 45, 90)
    cohort_anchor: int = 1          # 1-based period index of the cohort
    n_silent: int = 2               # silent periods that confirm churn
    keep: str = "first"             # duplicate resolution: 'first' | 'latest'

    @property
    def primary(self) -> Definition:
        return self.definitions[0]

    @property
    def strict(self) -> Definition:
        return self.definitions[1] if len(self.definitions) > 1 else self.definitions[0]

    def with_(self, **kw) -> "ChurnSpec":
        return replace(self, **kw)


DEFAULT_SPEC = ChurnSpec()

# The spec used for the driver tables (TPC-H-like dates): calendar 1996.
ADAPTER_SPEC = ChurnSpec(period_start=dt.date(1996, 1, 1), period_end=dt.date(1996, 12, 31))

# The spec used for the driver's ``events`` table: weekly periods over January 2024.
WEEKLY_SPEC = ChurnSpec(period_start=dt.date(2024, 1, 1), period_end=dt.date(2024, 1, 31), grain="week")
