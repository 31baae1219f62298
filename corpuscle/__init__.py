"""Text-corpus analytics and retrieval as Spark DataFrame jobs."""
