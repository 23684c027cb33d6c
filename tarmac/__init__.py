"""tarmac: on-time-performance analytics as plain Spark DataFrame functions."""
