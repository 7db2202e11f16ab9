"""Market-data analytics and corpus building as Spark jobs."""
