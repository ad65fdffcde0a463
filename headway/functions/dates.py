"""Run dates. Plain driver-side values: they parameterise a plan, they are not data."""

from __future__ import annotations

from datetime import date, datetime, timedelta


def resolve_run_date(raw: str | date) -> date:
    """A schedule's timestamp means the day before; a bare date means itself."""
    if isinstance(raw, datetime):
        return raw.date() - timedelta(days=1)
    if isinstance(raw, date):
        return raw
    day = date.fromisoformat(raw[:10])
    return day - timedelta(days=1) if len(raw) > 10 else day


def last_days(end: date, days: int) -> list[date]:
    """The ``days`` dates up to and including ``end``, oldest first."""
    return [end - timedelta(days=back) for back in range(days - 1, -1, -1)]
