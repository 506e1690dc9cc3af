"""A lakehouse access engine on PySpark."""
