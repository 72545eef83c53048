"""US federal holidays as a column expression on a date."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (month, day, first year).
FIXED_DATES = ((1, 1, 1871), (6, 19, 2021), (7, 4, 1871), (11, 11, 1954), (12, 25, 1871))
# Fixed values: (month, weekday with Monday = 0, first and last possible day, first year).
FLOATING = (
    (1, 0, 15, 21, 1986),   # third Monday of January
    (2, 0, 15, 21, 1971),   # third Monday of February
    (5, 0, 25, 31, 1971),   # last Monday of May
    (9, 0, 1, 7, 1894),     # first Monday of September
    (10, 0, 8, 14, 1971),   # second Monday of October
    (11, 3, 22, 28, 1942),  # fourth Thursday of November
)


def _fixed(d: Column) -> Column:
    return reduce(
        or_,
        [(F.month(d) == m) & (F.day(d) == day) & (F.year(d) >= start) for m, day, start in FIXED_DATES],
    )


def is_us_holiday(d: Column | str) -> Column:
    """True on the holiday and on its observed weekday (Saturday to Friday, Sunday to Monday)."""
    d = F.col(d) if isinstance(d, str) else d
    floating = reduce(
        or_,
        [
            (F.month(d) == m) & (F.weekday(d) == weekday) & F.day(d).between(first, last) & (F.year(d) >= start)
            for m, weekday, first, last, start in FLOATING
        ],
    )
    observed = ((F.weekday(d) == 4) & _fixed(F.date_add(d, 1))) | ((F.weekday(d) == 0) & _fixed(F.date_sub(d, 1)))
    return _fixed(d) | floating | observed
