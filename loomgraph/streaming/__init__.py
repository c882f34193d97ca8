"""Documents as a stream."""
