"""Named questions, end-to-end jobs, and their binding to the test tables."""
