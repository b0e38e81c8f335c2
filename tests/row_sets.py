"""Comparing frames in tests."""


def rows(df):
    """All rows as tuples, in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
