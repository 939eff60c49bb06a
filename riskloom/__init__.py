"""Behavioural transaction risk scoring as plain Spark DataFrame functions."""
