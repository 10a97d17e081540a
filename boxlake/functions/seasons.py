"""Season texts such as ``2024-25``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First month of a season, and the year bounds of the two checks.
FIRST_MONTH = 10
ANY_YEARS = (1000, 9999)
LEAGUE_YEARS = (1946, 2100)


def season_of_date(day: Column, override: str | None = None) -> Column:
    """Season a day belongs to; a configured season wins over the calendar."""
    first_year = F.year(day) - F.when(F.month(day) < FIRST_MONTH, 1).otherwise(0)
    second_year = F.lpad(F.pmod(first_year + 1, F.lit(100)).cast("string"), 2, "0")
    text = F.concat(first_year.cast("string"), F.lit("-"), second_year)
    return F.coalesce(F.lit(override or None).cast("string"), text)


def is_season_text(text: Column, years: tuple[int, int] = ANY_YEARS) -> Column:
    """True for ``YYYY-YY`` with the second year following the first; NULL is false."""
    parts = F.split(text, "-")
    first_year = F.get(parts, F.lit(0)).try_cast("int")
    second_year = F.get(parts, F.lit(1)).try_cast("int")
    return F.coalesce(
        (F.char_length(text) == 7)
        & (F.size(parts) == 2)
        & first_year.between(*years)
        & (second_year == F.pmod(first_year + 1, F.lit(100))),
        F.lit(False),
    )
