"""Change-data-capture event processing on Spark DataFrames."""
