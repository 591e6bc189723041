"""Per-window metrics over streams of JSON user records, on Spark DataFrames."""
