"""Cash-flow features, scoring and ranking as Spark jobs."""
