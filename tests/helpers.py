"""Helpers that tests import by name."""


def column(df, name, order=None):
    """The values of one column as a list."""
    return [r[name] for r in (df.orderBy(order) if order else df).collect()]
