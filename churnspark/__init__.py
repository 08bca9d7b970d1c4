"""Churn analytics over user event logs, written as plain Spark DataFrame jobs."""
