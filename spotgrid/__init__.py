"""Planning grids, reach estimates and plan jobs for television promotion, as Spark DataFrames."""
