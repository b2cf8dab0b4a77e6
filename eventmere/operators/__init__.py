"""Data operators the jobs are put together from."""
