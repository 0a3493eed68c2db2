"""Column builders: change envelope, record keys, layout columns."""
