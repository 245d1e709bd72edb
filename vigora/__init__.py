"""vigora: structuring, querying and checking document collections on Spark DataFrames."""
