"""Plan inspection, layout experiments and the query catalogue."""
