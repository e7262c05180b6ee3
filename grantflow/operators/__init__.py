"""Frame operators: DataFrames in, DataFrame out."""
