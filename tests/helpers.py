"""What several test files use."""


def rows(df, *order):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
