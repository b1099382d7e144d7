"""Entity linking and corpus preparation on Spark DataFrames."""
