"""tidemark: point-in-time panel analytics on PySpark DataFrames."""
