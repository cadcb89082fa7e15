"""Timestamp parsing and formatting."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylake.schemas import TIMESTAMP_FORMAT

_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def _fixed_width(text: Column) -> Column:
    """Text of the fixed-width format by a plain cast, null where the cast could take
    another form for it (short fields, spaces around, a zone, year 0)."""
    marks = {5: "-", 8: "-", 11: " ", 14: ":", 17: ":"}
    shape = (F.length(text) == 19) & (text >= "0001") & (text < ":") \
        & F.substring(text, 19, 1).between("0", "9")
    for at, mark in marks.items():
        shape = shape & (F.substring(text, at, 1) == mark)
    return F.when(shape, text.try_cast("timestamp_ntz"))


def parse_lenient(text: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """unparsable -> null.  Validity is tested with ``try_to_timestamp``
    and the value is built with ``to_timestamp_ntz`` only for valid rows, so
    the result is a wall-clock timestamp regardless of the session zone.  Texts of the
    fixed-width format are cast, which costs a tenth of a formatter."""
    ok = F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
    parsed = F.when(ok, F.to_timestamp_ntz(text, F.lit(fmt)))
    return F.coalesce(_fixed_width(text), parsed) if fmt == TIMESTAMP_FORMAT else parsed


def parse_strict(text: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """null stays null, anything unparsable aborts the job (even with
    ANSI mode off)."""
    return F.coalesce(parse_lenient(text, fmt), F.when(
        text.isNotNull(), F.raise_error(F.concat(F.lit("unparsable timestamp: "), text))
        .cast("timestamp_ntz")))


def format_ts(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text, as the reference stores it."""
    return F.date_format(ts, TIMESTAMP_FORMAT)


def parse_day(day) -> _dt.date:
    """Validate a target day given as text or date (``2026-8-1`` is rejected)."""
    if isinstance(day, _dt.datetime):
        return day.date()
    if isinstance(day, _dt.date):
        return day
    text = str(day)
    if not _DAY.fullmatch(text):
        raise ValueError(f"target day must be YYYY-MM-DD, got {day!r}")
    return _dt.date.fromisoformat(text)


def yesterday(today: _dt.date | str | None = None) -> _dt.date:
    """Default target day, resolved once on the driver.  ``today``: another
    clock's day (a late run of a scheduled load)."""
    now = _dt.date.today() if today is None else parse_day(today)
    return now - _dt.timedelta(days=1)
