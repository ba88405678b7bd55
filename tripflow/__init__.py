"""tripflow: trip-record analytics on Spark DataFrames."""
