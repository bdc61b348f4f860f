"""The shop's tables as pure functions: DataFrames in, DataFrames out."""
