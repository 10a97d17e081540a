"""Small game-level expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxlake.functions.parsing import strip


def iso_date(text: Column) -> Column:
    """Date from the first ten characters of an ISO text, NULL when unreadable."""
    head = F.substring(text, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))


def iso_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp")


def is_home(team: Column, home: Column, away: Column) -> Column:
    """True, false, or NULL for a team that is neither side."""
    return F.when(team == home, F.lit(True)).when(team == away, F.lit(False))


def opponent(team: Column, home: Column, away: Column) -> Column:
    return F.when(team == home, away).when(team == away, home)


def full_name(first: Column, last: Column) -> Column:
    joined = F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))
    return F.nullif(strip(joined), F.lit(""))
