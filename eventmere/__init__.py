"""Event-log lake and reporting jobs on PySpark DataFrames."""
