"""Address-activity labelling, scoring and monitoring on Spark DataFrames."""
