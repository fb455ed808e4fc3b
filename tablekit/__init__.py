"""tablekit: move, check and govern large sets of tables with Spark DataFrames."""
