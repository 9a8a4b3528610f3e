"""Dates, durations and quota days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Time zone of the quota day.
QUOTA_ZONE = "America/Los_Angeles"


def duration_seconds(text: Column) -> Column:
    """'34s' or '1.5s' as seconds, else null."""
    return F.nullif(F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*s\s*$", 1), F.lit("")).try_cast("double")


def quota_day(epoch: Column) -> Column:
    """The quota day of an epoch second."""
    return F.date_format(F.from_utc_timestamp(F.timestamp_seconds(epoch), QUOTA_ZONE), "yyyy-MM-dd")


def next_quota_midnight(epoch: Column) -> Column:
    """Epoch second at which the next quota day begins, by the clock on the wall."""
    return F.unix_timestamp(F.to_utc_timestamp(F.date_add(F.to_date(quota_day(epoch)), 1).cast("timestamp"), QUOTA_ZONE))


def reset_seconds(output: Column) -> Column:
    """Seconds until a quota is reset: of a retryDelay, else of 'Resets in 2h30m', hours, minutes and the first seconds named anywhere."""
    num = lambda p: F.coalesce(F.nullif(F.regexp_extract(output, p, 1), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))
    delay = F.nullif(F.regexp_extract(output, r'"retryDelay"\s*:\s*"([0-9]+)', 1), F.lit("")).try_cast("bigint")
    return F.coalesce(delay, num(r"Resets in ([0-9]+)h") * 3600 + num(r"Resets in (?:[0-9]+h)?([0-9]+)m") * 60 + num(r"([0-9]+)s"))


def date_problem(value: Column, today: Column) -> Column:
    """'format', 'invalid' or 'future' for a value that is no past ISO date, else null; null and empty values have no problem."""
    day = F.try_to_date(F.left(value, F.lit(10)), "yyyy-MM-dd")
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit(None)).when(~value.rlike(r"^\d{4}-\d{2}-\d{2}"), F.lit("format")).when(day.isNull(), F.lit("invalid")).when(day > today, F.lit("future"))


def note_date(doc_date: Column, extracted_at: Column, today: Column) -> Column:
    """The date of a note: its own, else that of its extraction, else today."""
    return F.coalesce(F.nullif(doc_date, F.lit("")), F.nullif(F.left(extracted_at, F.lit(10)), F.lit("")), F.date_format(today, "yyyy-MM-dd"))
