"""Table operators: ``DataFrame -> DataFrame``, for batch and stream alike."""
