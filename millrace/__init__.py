"""millrace: training-data curation, answer scoring and serving telemetry as PySpark DataFrame transformations."""
