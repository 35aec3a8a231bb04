"""lectern: knowledge-base analytics on Spark DataFrames."""
