"""DataFrame operators of the change feed and of its consumers."""
