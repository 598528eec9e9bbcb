"""Three-way dataset splits, drift statistics and model search on Spark DataFrames."""
