"""Statistical data cubes on Spark: ingest, model, normalize and query published cubes."""
