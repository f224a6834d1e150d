"""Event-log analytics on PySpark batch and Structured Streaming DataFrames."""
