"""Source profiling."""
