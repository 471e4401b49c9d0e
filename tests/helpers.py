"""Shared by the tests beside it."""


def rows(df, *columns):
    """The rows as a sorted list of tuples, NULLs included."""
    picked = df.select(*columns) if columns else df.select(*sorted(df.columns))
    return sorted((tuple(r) for r in picked.collect()), key=repr)
