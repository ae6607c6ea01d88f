"""millrace: analytic operators and pipelines written on the PySpark DataFrame API."""
