"""DataFrame operators: parsing, sessions, scoring, quality, splits, metrics."""
