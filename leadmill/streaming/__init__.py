"""Continuous form of the jobs."""
