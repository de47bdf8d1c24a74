"""Product-catalog reconciliation on Spark DataFrames."""
