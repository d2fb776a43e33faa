"""Report-period tokens.

A token ``MON/YY`` (case-insensitive) names an observation month; the report date used to collect features is the last
day of the month two months earlier, so JAN and FEB roll back into the previous year (``DEC/20`` -> 2020-10-31).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations accepted in tokens, in calendar order.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def report_date_col(token: str | Column) -> Column:
    """Column form: ``last_day(add_months(to_date(initcap(token), 'MMM/yy'), -2))``."""
    t = F.col(token) if isinstance(token, str) else token
    return F.last_day(F.add_months(F.to_date(F.initcap(t), "MMM/yy"), -2))


def report_date(token: str) -> dt.date:
    """Driver form for configuration values (a handful of tokens): the day before the first of the month that precedes
    the token's month."""
    name, _, years = token.strip().lower().partition("/")
    following = 12 * (2000 + int(years)) + MONTHS.index(name) - 1     # months since year 0 of the month after the date
    return dt.date(following // 12, following % 12 + 1, 1) - dt.timedelta(days=1)


def report_dates(tokens: str | list[str]) -> list[dt.date]:
    if isinstance(tokens, str):
        tokens = tokens.split()
    return [report_date(t) for t in tokens]
