"""Behaviour analytics and item recommendation as plain Spark jobs."""
