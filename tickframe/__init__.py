"""Market time-series operators and corpus operators as lazy Spark DataFrames."""
