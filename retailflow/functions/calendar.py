"""Calendar column expressions (year, month, quarter, names, weekend flag)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import WEEKEND_DAYS, col

# --- fixed values: month and weekday names per locale ------------------------
MONTH_NAMES = {
    "en": ("January", "February", "March", "April", "May", "June", "July",
           "August", "September", "October", "November", "December"),
    "pt": ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho",
           "agosto", "setembro", "outubro", "novembro", "dezembro"),
}
# index 0 = Sunday (dayofweek 1) ... index 6 = Saturday (dayofweek 7)
WEEKDAY_NAMES = {
    "en": ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"),
    "pt": ("domingo", "segunda-feira", "terça-feira", "quarta-feira", "quinta-feira",
           "sexta-feira", "sábado"),
}
# -----------------------------------------------------------------------------


def _name_lookup(names: tuple[str, ...], idx: Column) -> Column:
    """1-based index into a fixed name list (array literal, no join)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), idx)


def month_name(d: str | Column, locale: str = "en") -> Column:
    return _name_lookup(MONTH_NAMES[locale], F.month(col(d)))


def weekday_name(d: str | Column, locale: str = "en") -> Column:
    return _name_lookup(WEEKDAY_NAMES[locale], F.dayofweek(col(d)))


def calendar_columns(d: str | Column, locale: str = "en") -> dict[str, Column]:
    """The ten calendar attributes of a date, in output order."""
    x = col(d)
    return {
        "year": F.year(x),
        "month": F.month(x),
        "day_of_month": F.dayofmonth(x),
        "quarter": F.quarter(x),
        "year_month": F.date_format(x, "yyyy-MM"),
        "month_name": month_name(x, locale),
        "weekday_num": F.dayofweek(x),
        "weekday_name": weekday_name(x, locale),
        "is_weekend": F.dayofweek(x).isin(*WEEKEND_DAYS),
    }


def season_factor(d: str | Column, amplitude: float = 0.15) -> Column:
    """Weekly season: 1 + amplitude * sin(2*pi*(dayofweek - 1) / 7); Sunday is 1.0."""
    return F.lit(1.0) + F.lit(amplitude) * F.sin(
        F.lit(2.0) * F.pi() * (F.dayofweek(col(d)) - F.lit(1)) / F.lit(7))
