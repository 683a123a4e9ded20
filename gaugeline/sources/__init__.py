"""Sources. Each has ``read_stream(spark)`` and ``read_batch(spark)``, both returning a DataFrame."""
