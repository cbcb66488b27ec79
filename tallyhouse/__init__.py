"""Payment analytics on Spark: layers, star schema, checks, increments, streams."""
