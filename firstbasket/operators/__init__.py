"""DataFrame operators: every function takes DataFrames plus parameters and returns a DataFrame."""
