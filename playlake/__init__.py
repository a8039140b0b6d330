"""Star schemas and serving tables from play-event logs and song metadata, as Spark jobs."""
