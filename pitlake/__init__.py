"""pitlake: point-in-time-correct tables and queries on PySpark."""
