"""Calendar columns and date ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.config import COVID_RANGE, SEASON_END, SEASON_START


def with_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Sunday is day 0; weekend is Saturday and Sunday, midweek Tuesday to Thursday."""
    day = F.dayofweek(date) - 1
    return df.withColumns({
        "day_of_week": day,
        "month": F.month(date),
        "is_weekend": day.isin(0, 6),
        "is_midweek": day.isin(2, 3, 4),
    })


def in_range(col: Column, bounds: tuple[dt.date, dt.date] | None = COVID_RANGE) -> Column:
    """Inside a closed date range; false everywhere without one."""
    if bounds is None:
        return F.lit(False)
    return col.between(F.lit(bounds[0]), F.lit(bounds[1]))


def with_covid_flag(df: DataFrame, bounds: tuple[dt.date, dt.date] | None = COVID_RANGE) -> DataFrame:
    return df.withColumn("is_covid_affected", in_range(F.col("date"), bounds))


def in_season(col: Column) -> Column:
    """Between the opening and closing day of the date's own year."""
    first, last = (F.make_date(F.year(col), F.lit(m), F.lit(d)) for m, d in (SEASON_START, SEASON_END))
    return col.between(first, last)
