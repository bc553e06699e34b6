"""lakestrata: layered (Bronze -> Silver -> Gold) warehouse building blocks on Spark DataFrames."""
