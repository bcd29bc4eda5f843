"""brindle: evidence ranking and corpus preparation on Spark DataFrames."""
