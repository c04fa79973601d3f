"""Helpers of the library's tests. Not in conftest.py, since two modules of that name are loaded in one run."""


def rows(df, *columns):
    """Sorted list of tuples, NULL first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(type(v)), v) for v in r])
