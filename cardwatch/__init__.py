"""Card-transaction analytics and classifier monitoring on Spark DataFrames."""
