"""Column expressions: no function in here triggers a job."""
