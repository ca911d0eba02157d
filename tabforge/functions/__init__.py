"""Column expressions. Nothing here starts a job."""
