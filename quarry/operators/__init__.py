"""Table and stream operators: DataFrames in, DataFrame out."""
