"""Quality control of oceanographic depth profiles with Spark DataFrames."""
