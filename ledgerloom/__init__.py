"""Event-session and labelled-text analytics written as Spark DataFrame operations."""
