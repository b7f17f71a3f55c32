"""Column profiling, value recognition and service-request reports on Spark."""
