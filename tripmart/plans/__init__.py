"""Layer builders, business queries and batch jobs."""
