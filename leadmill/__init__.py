"""Turns raw unclaimed-property listings into a ranked list of leads, on Spark."""
