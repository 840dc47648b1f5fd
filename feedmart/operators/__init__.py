"""DataFrame operators: each takes and returns DataFrames and runs nothing."""
