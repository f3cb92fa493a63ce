"""Analytics over code-hosting activity events, as plain PySpark jobs."""
