"""Planning, configuration, checkpoints, run records."""
