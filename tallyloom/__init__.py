"""Business-analytics operators on PySpark DataFrames."""
