"""daybook: day-level attendance wide tables, built and maintained with Spark."""
