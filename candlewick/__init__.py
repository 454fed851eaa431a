"""candlewick: price-series lakehouse operators for Spark DataFrames."""
