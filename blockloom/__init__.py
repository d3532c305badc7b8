"""blockloom: chain analytics as PySpark DataFrame jobs."""
