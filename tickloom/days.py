"""Days as arguments."""

from __future__ import annotations

import datetime as dt


def as_date(day: dt.date | str) -> dt.date:
    """A day given as a date, a datetime or ISO text, with dashes or without.

    Every public entry turns its days into dates here, so no cast of text depends on the session.
    """
    if isinstance(day, dt.datetime):
        return day.date()
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)
