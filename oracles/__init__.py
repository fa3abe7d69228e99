"""Independent SQL statements of every query, for comparison on another engine."""
