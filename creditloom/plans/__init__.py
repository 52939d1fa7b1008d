"""Shipped rules, jobs and the query catalogue."""
