"""Analytics over streams and tables of user records, built on Spark DataFrames."""
