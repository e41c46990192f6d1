"""What the jobs write."""
