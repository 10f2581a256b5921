"""Entity-by-period panel analytics expressed as Spark DataFrames."""
