"""Tables the jobs read."""
