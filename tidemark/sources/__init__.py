"""Readers: sliced JDBC extracts and the raw zone."""
