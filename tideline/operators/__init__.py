"""DataFrame operators of the change-data engine."""
