"""Queries that run every operator over the TPC-H-like test tables, each with an SQL twin."""
