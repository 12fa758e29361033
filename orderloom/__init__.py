"""Order analytics as Spark jobs: ingest, clean, join, aggregate, forecast, check."""
