"""Data jobs composed from operators. All take and return DataFrames."""
