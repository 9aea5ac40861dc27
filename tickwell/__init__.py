"""Market-quote analytics as Spark jobs: ingest, quality, features, risk, models."""
