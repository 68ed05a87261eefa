"""Named DataFrame operators composed from built-in Spark expressions."""
