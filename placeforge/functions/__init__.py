"""Functions of the place engine."""
