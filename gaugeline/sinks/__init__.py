"""Destinations. Tables have ``write_stream(df)`` and ``write_batch(df)``."""
