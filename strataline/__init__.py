"""Medallion-style data work as plain Spark DataFrame operators."""
