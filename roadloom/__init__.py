"""Evidence-to-hotspot analytics on Spark DataFrames."""
