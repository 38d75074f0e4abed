"""Larkspur: retail and food-truck analytics as plain Spark jobs."""
