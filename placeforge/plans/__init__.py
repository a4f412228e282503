"""Plans of the place engine."""
