"""Point-in-time feature tables on plain Spark DataFrames."""
