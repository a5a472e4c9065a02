"""Media-catalog and subtitle analytics as Spark jobs."""
