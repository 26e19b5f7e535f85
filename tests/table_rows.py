"""What a test compares: the rows of a table."""


def rows(df, *order):
    """Rows as plain tuples, sorted by their text unless an order is asked for."""
    collected = [tuple(row) for row in (df.orderBy(*order) if order else df).collect()]
    return collected if order else sorted(collected, key=repr)
