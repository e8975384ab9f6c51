"""Monthly, config-driven risk scoring on Spark DataFrames."""
