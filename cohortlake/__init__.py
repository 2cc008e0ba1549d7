"""Student-outcome analytics as PySpark DataFrame, streaming and MLlib jobs."""
