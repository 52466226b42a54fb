"""What several test modules share."""


def rows(df, *columns):
    """Rows as a sorted list of tuples; nulls sort first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])
