"""lakemill: warehouse loading and querying on PySpark DataFrames."""
