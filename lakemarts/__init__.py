"""Lakehouse marts for retail banking, written as plain Spark DataFrame code."""
