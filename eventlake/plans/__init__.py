"""Configuration, layer composition, reports and the query catalogue."""
