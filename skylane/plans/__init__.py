"""Jobs and the query catalog."""
