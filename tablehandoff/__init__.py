"""File-handoff data jobs on Spark: stage, export, deliver, verify, and keep track."""
