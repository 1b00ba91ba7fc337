"""Entity-time panel preparation and analysis on Spark DataFrames."""
