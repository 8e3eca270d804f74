"""Jobs on unbounded input."""
