"""Readers: stored tables, JDBC, readings derived from the test tables, generated samples, small literal frames."""
