"""Analytics operators and named queries built on the PySpark DataFrame API."""
