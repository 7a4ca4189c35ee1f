"""Report parameters: scope lists, the period, and the periods derived from it."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, time, timedelta


@dataclass(frozen=True)
class Period:
    """A period that includes both ends, in zone-free wall-clock time."""

    start: datetime
    end: datetime

    def shifted(self, hours: int) -> Period:
        delta = timedelta(hours=hours)
        return Period(self.start + delta, self.end + delta)

    def previous(self) -> Period:
        """The comparison period: as many days, ending two days before ``start``.

        The day just before ``start`` belongs to neither period; the dashboard
        has always compared this way, so the gap is kept.
        """
        days = (self.end.date() - self.start.date()).days
        last = self.start.date() - timedelta(days=2)
        first = last - timedelta(days=days)
        return Period(datetime.combine(first, time.min), datetime.combine(last, time(23, 59, 59)))

    def year_before(self) -> Period:
        """The same dates one year earlier (29 February becomes the 28th)."""

        def back(ts: datetime) -> datetime:
            leap_day = (ts.month, ts.day) == (2, 29)
            return ts.replace(year=ts.year - 1, day=28 if leap_day else ts.day)

        return Period(back(self.start), back(self.end))


@dataclass(frozen=True)
class ReportParams:
    """What a dashboard call asks for. An empty list means "no such predicate".

    ``allowed_company_ids`` is the caller's security rule: ``None`` for no rule,
    otherwise it is intersected with ``company_ids``. ``utc_offset_hours`` is the
    caller's distance from UTC; local bounds are moved back by it.
    """

    from_ts: datetime
    to_ts: datetime
    company_ids: tuple[int, ...] = ()
    tenant_ids: tuple[int, ...] = ()
    legal_entity_ids: tuple[int, ...] = ()
    store_ids: tuple[int, ...] = ()
    region_ids: tuple[int, ...] = ()
    customer_class_ids: tuple[int, ...] = ()
    driver_ids: tuple[int, ...] = ()
    allowed_company_ids: tuple[int, ...] | None = None
    utc_offset_hours: int = 0

    @property
    def local(self) -> Period:
        return Period(self.from_ts, self.to_ts)

    @property
    def period(self) -> Period:
        return self.local.shifted(-self.utc_offset_hours)

    @property
    def previous_period(self) -> Period:
        return self.local.previous().shifted(-self.utc_offset_hours)

    @property
    def year_before(self) -> Period:
        return self.local.year_before().shifted(-self.utc_offset_hours)

    def but(self, **changes) -> ReportParams:
        return replace(self, **changes)
