"""Change capture -> bronze log -> current state and access periods, on Spark DataFrames."""
