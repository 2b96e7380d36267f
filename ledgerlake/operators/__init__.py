"""DataFrame -> DataFrame operators (joins, grouping, windows, reshaping)."""
