"""Trade and GDP analytics on Spark DataFrames."""
