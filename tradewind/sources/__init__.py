"""Sources, sinks and column resolution."""
