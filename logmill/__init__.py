"""Web-access-log pipeline and analytics on Spark DataFrames."""
