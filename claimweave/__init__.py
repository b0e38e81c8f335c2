"""Claims and application-log analytics as plain Spark DataFrame operators."""
