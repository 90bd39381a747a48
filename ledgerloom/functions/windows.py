"""The windows every per-series operator shares.

All of them partition by keys that begin with the series, so one hash shuffle by series serves a whole
chain of operators. Their input holds one row per series and date (see `sources.rollup`), which bounds
a window partition by the calendar however many transactions a series has.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ledgerloom.params import DATE, SERIES


def keys(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def whole(by=SERIES):
    """All rows of a series, unordered."""
    return Window.partitionBy(*keys(by))


def ordered(by=SERIES, order=DATE):
    return Window.partitionBy(*keys(by)).orderBy(order)


def before(by=SERIES, order=DATE):
    """Every row up to and with this one."""
    return ordered(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def all_ordered(by=SERIES, order=DATE):
    return ordered(by, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def near(back: int, ahead: int, by=SERIES, order=DATE):
    """Rows from `back` before this one to `ahead` after it."""
    return ordered(by, order).rowsBetween(-back, ahead)


def latest_first(by=SERIES, order=DATE):
    return Window.partitionBy(*keys(by)).orderBy(F.col(order).desc())


def position(by=SERIES, order=DATE) -> Column:
    """Zero-based row position inside the series."""
    return F.row_number().over(ordered(by, order)) - 1


def last_known(c: Column, by=SERIES, order=DATE) -> Column:
    return F.last_value(c, ignoreNulls=True).over(before(by, order))


def next_known(c: Column, by=SERIES, order=DATE) -> Column:
    """Read backwards, so that the frame grows by a row at a time; a frame from here to the end is summed up anew at every row."""
    backwards = latest_first(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last_value(c, ignoreNulls=True).over(backwards)


def first_of(c: Column, by=SERIES, order=DATE) -> Column:
    return F.first_value(c).over(all_ordered(by, order))


def change(c: Column, rows: int = 1, by=SERIES, order=DATE) -> Column:
    """Relative change against the value `rows` rows earlier; null where that is null or zero."""
    return F.try_divide(c, F.lag(c, rows).over(ordered(by, order))) - 1
