"""siltline: record curation, calibration and corpus preparation as plain Spark jobs."""
