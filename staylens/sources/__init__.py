"""Sources, sinks and landing jobs."""
