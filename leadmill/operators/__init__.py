"""Functions from DataFrames to DataFrames, one module per stage."""
