"""Column and SQL-text helpers for the numeric rules and window specs."""
