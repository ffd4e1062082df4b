"""Run parameters of a training or correction request."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
# Statuses that make an order dead (skip / cancel / unpaid):
DEAD_STATUSES = (
    "not_paid",
    "skipped_closed",
    "skipped_open",
    "admin_canceled_closed",
    "admin_canceled_open",
)
# Facility id -> facility time zone (inline relation in the reference):
FACILITY_ZONES = ((1, "US/Arizona"), (2, "US/Eastern"), (3, "US/Eastern"))
# First complete day of status history; planning never starts before
# this date plus the training window:
EVENT_HISTORY_START = "2019-03-30"
# Curve / checkpoint grid length (hours), minimum records per curve,
# training weeks (deployed default), freeze look-back (rows), days between
# finalization and ship date, local hour of alignment and finalization.
HORIZON_HOURS = 650
MIN_RECORDS = 100
TRAINING_WEEKS = 13
FREEZE_ROWS = 72
FINALIZATION_DAYS = 3
LOCAL_CUTOFF_HOUR = 17
# Grouping levels of the training set: (keep freight, keep plan).  A rolled-up part is shown as 0.
LEVELS = ((True, True), (False, True), (True, False), (False, False))
# Knowledge-time sentinel meaning "now".
CURRENT_TIMESTAMP = "CURRENT_TIMESTAMP"


def resolve_instant(value: str | dt.datetime | None, now: dt.datetime | None = None) -> dt.datetime:
    """Resolve a knowledge-time argument ONCE on the driver to an aware UTC datetime."""
    if value is None or (isinstance(value, str) and value.strip().upper() == CURRENT_TIMESTAMP):
        t = now or dt.datetime.now(dt.timezone.utc)
    elif isinstance(value, dt.datetime):
        t = value
    else:
        t = dt.datetime.fromisoformat(value.strip().replace("Z", "+00:00"))
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    return t.astimezone(dt.timezone.utc)


def instant_lit(t: dt.datetime) -> Column:
    """A TIMESTAMP literal for an aware datetime, independent of the driver's local zone."""
    return F.lit(t.astimezone(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")).cast("timestamp")


@dataclass(frozen=True)
class RunParams:
    """One request: knowledge time, clock, explicit ship dates and model knobs."""

    knowledge_time: str | dt.datetime | None = None
    now: str | dt.datetime | None = None
    ship_dates: tuple[str, ...] | None = None
    training_weeks: int = TRAINING_WEEKS
    min_records: int = MIN_RECORDS
    horizon: int = HORIZON_HOURS
    freeze_rows: int = FREEZE_ROWS
    strict_knowledge_time: bool = False  # Q6: reference does not KT-filter correction facts
    _resolved: dict = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self):
        now = resolve_instant(self.now)
        self._resolved["now"] = now
        self._resolved["kt"] = resolve_instant(self.knowledge_time, now)
        if self.ship_dates is not None:
            object.__setattr__(self, "ship_dates", tuple(str(d) for d in self.ship_dates))

    @property
    def kt(self) -> dt.datetime:
        return self._resolved["kt"]

    @property
    def now_ts(self) -> dt.datetime:
        return self._resolved["now"]

    def kt_col(self) -> Column:
        return instant_lit(self.kt)

    def now_col(self) -> Column:
        return instant_lit(self.now_ts)

    def with_(self, **kw) -> "RunParams":
        return replace(self, _resolved={}, **kw)


# The reference back-test request (README / commented test): ship date
# 2019-09-20 at knowledge time 2019-09-17T16:00Z with 13 training weeks.
REFERENCE_KT = "2019-09-17T16:00:00+00:00"
