"""Object-centric inventory analytics as PySpark DataFrame jobs."""
