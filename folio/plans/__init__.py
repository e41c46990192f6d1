"""Named entry points that put the operators together."""
