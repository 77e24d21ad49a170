"""Query catalogue, reference SQL and the batch jobs."""
