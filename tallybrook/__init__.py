"""Order-event pipeline and reports on Spark."""
