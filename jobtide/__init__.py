"""Job-posting analytics on Spark: landing, modelling, quality checks and serving queries."""
