"""Small helpers that tests share."""

import datetime as dt

T0 = dt.datetime(2024, 1, 1)


def at(second):
    return T0 + dt.timedelta(seconds=second)


def rows(df, *columns):
    """The rows of a frame as a sorted list of tuples."""
    return sorted(tuple(row) for row in df.select(*(columns or df.columns)).collect())
