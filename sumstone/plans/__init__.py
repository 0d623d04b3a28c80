"""End-to-end reports and the queries registered for the test tables."""
