"""Spark jobs that turn nested JSON feeds into keyed tables and daily price rollups."""
