"""Run parameters and per-deployment settings."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

DAY, WEEK, FYTD = "DAY", "WEEK", "FYtD"
ALL = "All"


def week_start(day: date) -> date:
    """Sunday on or before ``day`` (reporting weeks run Sunday to Saturday)."""
    return day - timedelta(days=(day.weekday() + 1) % 7)


@dataclass(frozen=True)
class RunParams:
    """Inclusive date range of a run, the clock it believes in, and the stamp it writes."""

    start: date
    end: date
    as_of: date | None = None
    run_ts: datetime = datetime(2000, 1, 1)

    def __post_init__(self):
        if self.start > self.end:
            raise ValueError(f"run starts {self.start} after it ends {self.end}")
        if self.as_of is None:
            object.__setattr__(self, "as_of", self.end)

    @property
    def first_week(self) -> date:
        return week_start(self.start)

    @property
    def last_week(self) -> date:
        return week_start(self.end)

    @classmethod
    def daily(cls, day: date, **kw) -> "RunParams":
        return cls(day, day, **kw)

    @classmethod
    def weekly(cls, saturday: date, **kw) -> "RunParams":
        return cls(saturday - timedelta(days=6), saturday, **kw)

    @classmethod
    def year_to_date(cls, day: date, **kw) -> "RunParams":
        return cls(day - timedelta(days=364), day, **kw)


def weekly_scopes_due(day: date) -> bool:
    """WEEK, FYtD and the reports run once the reporting week closes, on Saturday."""
    return day.weekday() == 5


# List members the sources are filtered on.
EU_REGIONS = (
    "France", "Germany", "Inbound", "International", "Italy", "RoE", "Spain", "UK>EU", "Foreign Travel",
)
REPORT_REGIONS = EU_REGIONS + ("Total", "United Kingdom")
PRODUCT_LINES = ("EU", "UK", "UK & EU")


@dataclass(frozen=True)
class MartConfig:
    """Filters and switches shared by the marts. Defaults are the production values."""

    business_channel: str = "Leisure"
    managed_groups: tuple[str, ...] = ("20", "42")
    product_types: tuple[str, ...] = ("TRAVEL", "SEASONS", "SEASONS_FLEXI", "RAILCARD")
    source_systems: tuple[str, ...] = ("25KV", "SEASONS", "SGP", "TRACS")
    account_segment: str = "latest"
    eu_regions: tuple[str, ...] = EU_REGIONS
    # regions with weekly customer counts: Foreign Travel is left out at week grain
    weekly_customer_eu_regions: tuple[str, ...] = tuple(r for r in EU_REGIONS if r != "Foreign Travel")
    plan_regions: tuple[str, ...] = ("France", "Germany", "ROW", "Italy", "ROE", "Spain", "UK>EU", "United Kingdom")
    # the line-item look-back that re-reads late refunds and amendments
    line_lookback_days: int = 45
    # days of the look-back to read again; None reads them all
    late_days: tuple[date, ...] | None = None
    # hotel bookings come from a manual file before this date and from the feed after it
    hotel_feed_cutover: date = date(2024, 8, 1)
    web_outages: tuple[tuple[date, date], ...] = ((date(2024, 9, 15), date(2024, 10, 12)),)
    refund_fee_gaps: tuple[tuple[date, date], ...] = ((date(2023, 1, 1), date(2023, 1, 31)),)
    # "EUR" repeats what the stored marts hold for UK & EU totals, "GBP" is the other reading
    total_currency: str = "EUR"
    null_dimension: str = field(default="Unknown")
    # the stored mart and the state of its running totals, where a run carries them
    ytd_state: tuple[str, str] | None = None
