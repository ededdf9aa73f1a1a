"""Small helpers of the tests, in a module of their own name: there are two conftest files."""


def rows(df, *columns):
    """Sorted plain tuples, for comparing small results."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
