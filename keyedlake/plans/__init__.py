"""Fixtures, reports and the query catalogue."""
