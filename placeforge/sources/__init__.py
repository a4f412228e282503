"""Sources of the place engine."""
