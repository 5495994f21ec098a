"""Card-transaction network analytics on Spark DataFrames."""
