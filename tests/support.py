"""Helpers that the test modules import by name."""


def rows(df, *cols):
    """Sorted list of tuples for order-insensitive comparison."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
