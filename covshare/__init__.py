"""Population-weighted coverage analytics on Spark DataFrames."""
