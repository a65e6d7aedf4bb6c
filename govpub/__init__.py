"""Governed publication of disagreeing feeds, written as Spark DataFrame jobs."""
