"""Distributed building blocks that plain Spark operators do not give at table scale."""
