"""Clinical time-series analytics on PySpark."""
