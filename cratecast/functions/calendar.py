"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_calendar(df: DataFrame, date_col: str = "Fecha", iso_year: bool = False) -> DataFrame:
    """Add Mes, Year, Dia (Monday = 0) and Semana (ISO week).

    ``Year`` is the calendar year by default, so 2021-01-01 is week 53 of
    2021; ``iso_year=True`` gives the ISO week-numbering year instead.
    """
    d = F.col(date_col)
    year = F.extract(F.lit("YEAROFWEEK"), d) if iso_year else F.year(d)
    return df.withColumns(
        {
            "Mes": F.month(d),
            "Year": year.cast("int"),
            "Dia": F.weekday(d),
            "Semana": F.weekofyear(d),
        }
    )


def parse_day_first(c: Column | str, fmt: str = "dd/MM/yyyy") -> Column:
    """Parse a day-first date string with an explicit format (no guessing)."""
    return F.to_date(c, fmt)


def week_date(year: Column | str, week: Column | str) -> Column:
    """Representative date of a (year, week): January 1 plus 7 days per week."""
    y = F.col(year) if isinstance(year, str) else year
    w = F.col(week) if isinstance(week, str) else week
    return F.date_add(F.make_date(y, F.lit(1), F.lit(1)), (w * 7).cast("int"))


def weeks_between(lo: Column, hi: Column) -> Column:
    """Whole weeks between two dates: floor(days / 7)."""
    return F.floor(F.datediff(hi, lo) / 7).cast("int")
