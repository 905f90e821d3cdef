"""Dates and rows for the tests. No test module imports from a conftest, as there are two of that name."""

import datetime as dt


def day(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def moment(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


def rows(df, *order: str) -> list[tuple]:
    """The rows as tuples, sorted on the given columns (or as they come)."""
    return [tuple(row) for row in (df.orderBy(*order) if order else df).collect()]
