"""DataFrame -> DataFrame operators; thresholds and the current time are parameters."""
