"""Column expressions used inside the jobs."""
