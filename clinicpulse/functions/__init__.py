"""Column expressions and calendar helpers shared by the jobs."""
