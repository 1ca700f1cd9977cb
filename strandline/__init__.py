"""strandline: gene-by-gene typing analytics on Spark DataFrames."""
