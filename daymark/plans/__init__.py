"""Composed plans: the six-table daily build, the job, and the query catalog."""
