"""Answer-quality metrics.  Each metric has a row-level scorer (adds a score
column) and an aggregate (``group_by=None`` = one row for the whole input)."""
