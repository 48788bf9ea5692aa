"""Raw paper records to searchable vectors, as Spark jobs."""
