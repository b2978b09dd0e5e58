"""DataFrame-to-DataFrame operators; thresholds are keyword arguments."""
