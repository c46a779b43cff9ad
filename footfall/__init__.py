"""Web-analytics warehouse built from Spark DataFrames."""
