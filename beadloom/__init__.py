"""Split-pool barcode analytics as Spark jobs."""
