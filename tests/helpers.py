def rows(df, *cols):
    """Rows as sorted tuples, with NULL first."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t])
