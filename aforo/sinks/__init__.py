"""Writers for tables stored by file, by year and append-only."""
