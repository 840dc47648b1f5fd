"""The two feeds, and the tables they keep."""
