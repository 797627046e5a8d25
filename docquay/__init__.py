"""Landing, cleaning and accounting of published documents as Spark jobs."""
