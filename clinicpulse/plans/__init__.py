"""The analytics jobs."""
