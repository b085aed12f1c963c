"""Analytics over published healthcare prices, built on Spark DataFrames."""
