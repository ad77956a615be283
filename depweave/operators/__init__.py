"""DataFrame operators: every function takes and returns DataFrames and runs no action."""
